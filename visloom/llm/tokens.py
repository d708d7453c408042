"""Token counts: texts are encoded in batches in Arrow functions, and only lengths come back.

Batches are balanced by bytes, not rows. A text beyond ``LONG_BYTES`` is split where no piece of the
vocabulary can reach across: before a single space between two characters that are no white space, as pieces hold the
space mark only at their start. The encoder puts a mark in front of each text, so the space itself goes.
Where the vocabulary has a piece with an inner mark, or no such place exists, the text stays whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; each row counts, repeats included; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
LONG_BYTES = 1 << 16
BATCH_BYTES = 1 << 20
MARK = "▁"


@lru_cache(maxsize=4)
def encoder(path: str):
    """The model at ``path`` and whether a text may be split before a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # An identity normaliser keeps runs of spaces and adds one mark in front.
    plain = model.encode("a  b", out_type=str) != model.encode("a b", out_type=str) and model.encode("a", out_type=str)[0].startswith(MARK)
    return model, plain and not any(MARK in p.lstrip(MARK) for p in pieces)


def _joins(c: str) -> bool:
    """White space of any kind, which a normaliser may take for a space, and the space mark itself."""
    return c == MARK or c.isspace()


def _bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def split_long(text: str, most: int) -> list[str]:
    """Parts of about ``most`` bytes whose counts add up to the text's. A part may be a few times shorter where characters take several bytes."""
    most = max(1, most * len(text) // max(1, _bytes(text)))
    parts, start = [], 0
    while len(text) - start > most:
        at = text.find(" ", start + most)
        while at != -1 and (at + 1 >= len(text) or _joins(text[at - 1]) or _joins(text[at + 1])):
            at = text.find(" ", at + 1)
        if at == -1:
            break
        parts.append(text[start:at])
        start = at + 1
    return [*parts, text[start:]]


def lengths(texts: list[str], path: str, long_bytes: int = LONG_BYTES, batch_bytes: int = BATCH_BYTES) -> list[int]:
    model, may_split = encoder(path)
    counts = [0] * len(texts)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        for k, ids in zip(owners, model.encode(batch, num_threads=1), strict=True):
            counts[k] += len(ids)
        batch.clear()
        owners.clear()

    for k, text in enumerate(texts):
        for part in split_long(text, long_bytes) if may_split and _bytes(text) > long_bytes else (text,):
            batch.append(part)
            owners.append(k)
            held += _bytes(part)
            if held >= batch_bytes:
                flush()
                held = 0
    flush()
    return counts


def count_tokens(
    docs: DataFrame,
    model_path: str | None = None,
    limit: int = LIMIT,
    long_bytes: int = LONG_BYTES,
    batch_bytes: int = BATCH_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row. ``model_path`` must be readable on each executor; by default the installed one is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        for batch in batches:
            counts = lengths(batch.column(2).to_pylist(), str(path), long_bytes, batch_bytes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = common.text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return common.map_arrow(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(common.documents(spark, sf_dir))
