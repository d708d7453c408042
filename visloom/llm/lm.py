"""Scoring texts with a gated recurrent language model.

A text is its words and one end token. The ``WORDS`` most frequent training tokens are symbols of the model; all other words
stand for one of 16 symbols, by the upper half of their first byte, and have a share of it by their training counts.
The output softmax is factored: first the class of a symbol (ranges of word frequency, and one class for each of the 16), then
the word within its class. A gated recurrent network reads the symbols; its weights start at the
counts' own distribution and are trained in numpy by backpropagation through windows of ``STEPS`` symbols, the state going on from
window to window. All training documents train the network; they are dealt by a hash of their ids to ``ROUNDS`` rounds, in each of
which every partition trains a copy of the weights on its documents, and the copies are averaged by their numbers of tokens.
Scores are complete: the state is carried over all windows of a document.

Counts cover all training tokens. The ``LISTED`` most frequent words (of at most ``LISTED_BYTES`` bytes) are broadcast; the counts
of all others are joined by word, so that no frequent word is ever a key of that join. Averages are taken by groups of ``FAN``
partitions, twice, before the driver sees them.

Defined cases: a null or empty text is the end token alone; a null id counts as the empty string, whose checksum is 0, so the
row is learnt from; without training documents the model is uniform over its symbols; each row is scored by itself, repeats
included; ties between equally frequent words go to the first in byte order; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORDS = 1023
CLASS_SIZE = 32
STATE = 16
STEPS = 32
LANES = 128
ROUNDS = 3
RATE = 0.03
#: A task goes over its documents again until it has trained on so many tokens in a round.
LEAST_TOKENS = 120_000
LISTED, LISTED_BYTES = 1 << 18, 64
OFTEN = 1 << 12
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000
FAN = 64
#: Windows and lanes of scoring, which needs no memory of earlier steps.
SCORE_STEPS, SCORE_LANES = 32, 256
#: Symbols that are dealt to lanes at once, a document counting as ``ROW`` more. Lanes end together, unless a document is longer than they are.
HELD, ROW = 1 << 21, 64
GATHERED = 4 << 20
REST = 16
#: Logits within this need no largest one taken from them before their exponentials.
LOGIT = 60.0
LN10 = float(np.log(10))


# --- the network ------------------------------------------------------------------------------------


_ROOM: dict[tuple, np.ndarray] = {}


def room(name: str, shape: tuple[int, ...], dtype) -> np.ndarray:
    """An array that the last one of this name is overwritten by. Fresh memory for each window costs more time than the arithmetic in it."""
    size, key = int(np.prod(shape)), (name, np.dtype(dtype))
    held = _ROOM.get(key)
    if held is None or held.size < size:
        held = _ROOM[key] = np.empty(size, dtype)
    return held[:size].reshape(shape)


def with_one(h: np.ndarray, name: str) -> np.ndarray:
    """(places, state + 1) of ``h`` (state, places), the last a one that a bias is multiplied with."""
    out = room(name, (h.shape[1], len(h) + 1), h.dtype)
    out[:, :-1], out[:, -1] = h.T, 1
    return out


def places(states: np.ndarray, used: np.ndarray) -> np.ndarray:
    """(state, places) of the used places, from (steps, state, lanes)."""
    by_place = states.transpose(0, 2, 1)
    return (by_place.reshape(-1, by_place.shape[2]) if used.all() else by_place[used]).T


@dataclass
class Network:
    """Symbols 0 to words - 1 are tokens, then REST symbols for all other words, then the start of a text, which is only read."""

    words: int
    weights: dict[str, np.ndarray]
    class_size: int = CLASS_SIZE

    @property
    def symbols(self) -> int:
        return self.words + REST

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.class_size)

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.words, symbols // self.class_size, symbols - self.words + self.word_classes)

    @property
    def state(self) -> int:
        return self.weights["loop"].shape[0]

    @classmethod
    def start(cls, mass: np.ndarray, state: int = STATE, class_size: int = CLASS_SIZE, seed: int = 42) -> Network:
        """A network that, untrained, gives each symbol its share of ``mass``."""
        words = len(mass) - REST
        rng, h = np.random.default_rng(seed), state
        out = cls(words, {}, class_size)
        share = (mass + 1.0) / (mass + 1.0).sum()
        per_class = np.bincount(out.class_of(np.arange(len(mass))), share)
        inner = np.log(share[:words] / per_class[np.arange(words) // class_size])
        out.weights = {
            "read": rng.normal(0, 0.5, (len(mass) + 1, 3 * h)),
            "loop": rng.normal(0, h**-0.5, (h, 3 * h)),
            "loop_bias": np.zeros(3 * h),
            "class": np.zeros((h, len(per_class))),
            "class_bias": np.log(per_class),
            "word": np.zeros((words, h)),
            "word_bias": inner,
        }
        out.weights = {k: v.astype(np.float32) for k, v in out.weights.items()}
        return out

    def packed(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Parts of ``flat`` in the shapes of the weights."""
        out, at = {}, 0
        for k, w in self.weights.items():
            out[k] = flat[at : at + w.size].reshape(w.shape)
            at += w.size
        return out

    def unpacked(self, flat: np.ndarray) -> Network:
        return Network(self.words, {k: v.astype(self.weights[k].dtype) for k, v in self.views(flat).items()}, self.class_size)

    def forward(self, x: np.ndarray, h: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States (steps, state, lanes) after each row of ``x`` (steps, lanes), from ``h`` (state, lanes) on. ``keep`` gets what backward needs."""
        w, n, (steps, lanes), kind = self.weights, self.state, x.shape, h.dtype
        # By gate; update and reset with the other sign, as their exponentials take it.
        tables, loops = room("tables", (3, self.symbols + 1, n), kind), w["loop"].reshape(n, 3, n).transpose(1, 0, 2).copy()
        bias = w["loop_bias"].reshape(3, 1, n)
        tables[:] = w["read"].reshape(-1, 3, n).transpose(1, 0, 2)
        tables[:2] += bias[:2]
        np.negative(tables[:2], out=tables[:2])
        np.negative(loops[:2], out=loops[:2])
        bias = np.repeat(bias[2], lanes, 0)
        at = x[:, None].astype(np.intp) + (np.arange(3) * (self.symbols + 1))[:, None]
        read = np.take(tables.reshape(-1, n), at, axis=0, out=room("read", (steps, 3, lanes, n), kind), mode="clip")
        looped = room("looped", (steps if keep is not None else 1, 3, lanes, n), kind)
        out, part = room("states", (steps, lanes, n), kind), np.empty((lanes, n), kind)
        first, starts = np.ascontiguousarray(h.T), x == self.symbols
        h = first
        for t, some in enumerate(starts.any(1).tolist()):
            if some:
                h = h.copy()
                h[starts[t]] = 0
            now = looped[t % len(looped)]
            np.matmul(h, loops, out=now)
            gates, inner, new = now[:2], now[2], read[t, 2]
            gates += read[t, :2]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            inner += bias
            np.multiply(gates[1], inner, out=part)
            new += part
            np.tanh(new, out=new)
            after = out[t]
            np.subtract(h, new, out=after)
            after *= gates[0]
            after += new
            h = after
        if keep is not None:
            before = room("before", out.shape, kind)
            before[0], before[1:] = first, out[:-1]
            before[starts] = 0
            keep |= {"before": before, "update": looped[:, 0], "reset": looped[:, 1], "inner": looped[:, 2], "new": read[:, 2], "starts": starts}
        return out.transpose(0, 2, 1)

    def _by_class(self, y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Places of words in order of their classes; (class, first, last) of each class in that order."""
        own = np.where(y < self.words, y // self.class_size, self.word_classes).astype(np.int16)
        ends = np.cumsum(np.bincount(own, minlength=self.word_classes + 1)[: self.word_classes]).tolist()
        return np.argsort(own, kind="stable")[: ends[-1]], [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]

    @staticmethod
    def _exponentials(logits: np.ndarray, at: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
        """Turn ``logits`` into exponentials in place; their sums down each column, and the logarithm of the share of the one at ``at``."""
        if not bounded:
            logits -= logits.max(0)
        chosen = logits[at, np.arange(len(at))]
        np.exp(logits, out=logits)
        total = logits.sum(0)
        return total, chosen - np.log(total)

    def _classes(self, h: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For ``h`` (places, state and a one): the classes of ``y``, exponentials by class, their sums, logarithms of the probabilities."""
        w, own = self.weights, self.class_of(y)
        layer = np.vstack([w["class"], w["class_bias"]]).T
        logits = np.matmul(layer, h.T, out=room("classes", (len(layer), len(h)), h.dtype))
        return own, logits, *self._exponentials(logits, own, self._bounded(h, w["class"].T, w["class_bias"]))

    def _words(self, h: np.ndarray, y: np.ndarray) -> tuple:
        """For ``h`` (places, state and a one): places of words and their classes, their rows of ``h``, weights with the bias in the last column, words
        within the class, exponentials by word, their sums, logarithms of the probabilities."""
        w = self.weights
        order, classes = self._by_class(y)
        rows = np.take(h, order, axis=0, out=room("rows", (len(order), h.shape[1]), h.dtype), mode="clip")
        layer = np.zeros((self.word_classes * self.class_size, self.state + 1), h.dtype)
        layer[:, -1] = -1e9  # what fills the last class is never chosen
        layer[: self.words, :-1], layer[: self.words, -1] = w["word"], w["word_bias"]
        layer = layer.reshape(self.word_classes, self.class_size, -1)
        logits = room("words", (self.class_size, len(order)), h.dtype)
        for k, a, b in classes:
            np.matmul(layer[k], rows[a:b].T, out=logits[:, a:b])
        inner = y[order] % self.class_size
        return order, classes, rows, layer, inner, logits, *self._exponentials(logits, inner, self._bounded(h, w["word"], w["word_bias"]))

    @staticmethod
    def _bounded(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> bool:
        """Whether no exponential can overflow, nor a sum of them vanish, so that they need no largest one taken from them."""
        reach = max(1.0, float(h.max(initial=0)), -float(h.min(initial=0)))
        return bool((np.abs(weights).sum(1) * reach + np.abs(bias)).max(initial=0) < LOGIT)

    def log_probability(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of ``y`` after states ``h`` (state, places)."""
        h = with_one(h, "layered")
        *_, logs = self._classes(h, y)
        order, *_, more = self._words(h, y)
        logs[order] += more
        return logs

    def gradient(self, x: np.ndarray, y: np.ndarray, used: np.ndarray, h: np.ndarray, into: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean negative logarithm over the ``used`` places of one window, as views of ``into``; the state after it; the sum of logarithms."""
        w, n, (steps, lanes) = self.weights, self.state, x.shape
        flat = np.empty(sum(v.size for v in w.values()), h.dtype) if into is None else into
        flat.fill(0)
        grad, kept, target = self.views(flat), {}, y[used]
        states = self.forward(x, h, kept)
        layered = with_one(places(states, used), "layered")
        # Exponentials less their sum at the target, over that sum, are the gradient of the logits. The sums divide what has fewer rows.
        own, p, total, logs = self._classes(layered, target)
        p[own, np.arange(len(own))] -= total
        share = (1 / total)[:, None]
        both = p @ (layered * share)
        grad["class"][:], grad["class_bias"][:] = both[:, :-1].T, both[:, -1]
        back = np.matmul(p.T, w["class"].T, out=room("back", (len(target), n), h.dtype))
        back *= share
        order, classes, rows, layer, inner, p, total, more = self._words(layered, target)
        logs[order] += more
        p[inner, np.arange(len(inner))] -= total
        share = (1 / total)[:, None]
        rows *= share
        down = room("words back", (len(order) + 1, n), h.dtype)
        for k, a, b in classes:
            both, low, high = p[:, a:b] @ rows[a:b], k * self.class_size, min((k + 1) * self.class_size, self.words)
            grad["word"][low:high], grad["word_bias"][low:high] = both[: high - low, :-1], both[: high - low, -1]
            np.matmul(p[:, a:b].T, layer[k, :, :-1], out=down[a:b])
        down[:-1] *= share
        down[-1] = 0
        at = np.full(len(target), len(order))
        at[order] = np.arange(len(order))  # each place is in one class, or is no word's
        back += np.take(down, at, axis=0, out=room("words back by place", back.shape, h.dtype), mode="clip")
        if used.all():
            above = back.reshape(steps, lanes, n)
        else:
            above = room("above", (steps, lanes, n), h.dtype)
            above.fill(0)
            above[used] = back
        before, update, reset, inner, new, starts = kept.values()
        # What a step's gradient is multiplied with, of all steps at once.
        keeps = np.subtract(1, update, out=room("keeps", update.shape, h.dtype))
        to_update = np.subtract(before, new, out=room("to update", update.shape, h.dtype))
        to_update *= update
        to_update *= keeps
        to_new = np.multiply(new, new, out=room("to new", new.shape, h.dtype))
        np.subtract(1, to_new, out=to_new)
        to_new *= keeps
        to_reset = np.subtract(1, reset, out=keeps)
        to_reset *= reset
        to_reset *= inner
        every, news = room("every", (3, steps, lanes, n), h.dtype), room("news", new.shape, h.dtype)
        loops, three = w["loop"].reshape(n, 3, n).transpose(1, 2, 0).copy(), np.empty((3, lanes, n), h.dtype)
        later, some = np.zeros((lanes, n), h.dtype), starts.any(1).tolist()
        for t in reversed(range(steps)):
            d, d_new, d_all = above[t], news[t], every[:, t]
            d += later
            np.multiply(d, to_new[t], out=d_new)
            np.multiply(d, to_update[t], out=d_all[0])
            np.multiply(d_new, to_reset[t], out=d_all[1])
            np.multiply(d_new, reset[t], out=d_all[2])
            np.matmul(d_all, loops, out=three)
            np.multiply(d, update[t], out=later)
            for part in three:
                later += part
            if some[t]:
                later[starts[t]] = 0
        every, news = every.reshape(3, -1, n), news.reshape(-1, n)
        grad["loop"].reshape(n, 3, n)[:] = np.matmul(before.reshape(-1, n).T, every).transpose(1, 0, 2)
        grad["loop_bias"].reshape(3, n)[:] = every.sum(1)
        symbols = x.ravel().astype(np.int16 if self.symbols < 1 << 15 else x.dtype)  # 16 bits are sorted by digits
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.diff(symbols, prepend=-1))
        by_symbol = room("read by symbol", (len(order), 3, n), h.dtype)
        for k, part in enumerate((every[0], every[1], news)):
            by_symbol[:, k] = np.take(part, order, axis=0)
        grad["read"][symbols[first]] = np.add.reduceat(by_symbol.reshape(-1, 3 * n), first, axis=0)
        flat /= max(1, len(target))
        return grad, states[-1].copy(), float(logs.sum())


class Adam:
    """Moves ``flat`` in place. The means are kept undivided: ``mean`` is ten, ``square`` a thousand times the usual."""

    def __init__(self, flat: np.ndarray, rate: float = RATE):
        self.flat, self.rate, self.t = flat, rate, 0
        self.mean, self.square, self.part = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)

    def step(self, grad: np.ndarray, share: float = 1.0) -> None:
        """``share``: how full the window was. Else the last documents, alone in their lanes, would move the weights most."""
        self.t += 1
        by = self.rate * share * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        part = self.part
        self.mean *= 0.9
        self.mean += grad
        self.square *= 0.999
        self.square += np.multiply(grad, grad, out=part)
        np.sqrt(self.square, out=part)
        part += 1e-8 * 1000**0.5
        np.divide(self.mean, part, out=part)
        part *= by * 0.1 * 1000**0.5
        self.flat -= part


# --- windows over many documents --------------------------------------------------------------------


@dataclass
class Text:
    """A document's symbols, and what is known of its score."""

    symbols: np.ndarray
    row: tuple = ()
    log: float = 0.0


@dataclass
class Lanes:
    """Documents one after the other in lanes that are about equally long, the longest lane first."""

    texts: list[Text]
    symbols: np.ndarray  # of all lanes, one behind the other
    before: np.ndarray  # the symbol before each, or the start
    owner: np.ndarray  # which of texts each symbol is of
    starts: np.ndarray  # of lanes
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: list[Text], lanes: int, start: int) -> Lanes:
        """The longest documents are dealt first, each to the lane with least so far. In a lane, they keep their order."""
        sizes = [len(t.symbols) for t in texts]
        loads, lane = [(0, k) for k in range(lanes)], np.zeros(len(texts), np.int64)
        for k in sorted(range(len(texts)), key=sizes.__getitem__, reverse=True):
            load, its = loads[0]
            heapq.heapreplace(loads, (load + sizes[k], its))
            lane[k] = its
        lengths = np.zeros(lanes, np.int64)
        for load, k in loads:
            lengths[k] = load
        longest = np.argsort(-lengths, kind="stable")
        rank = np.empty_like(longest)
        rank[longest] = np.arange(lanes)
        order, lengths = np.argsort(rank[lane], kind="stable"), lengths[longest]
        symbols, sizes = np.concatenate([texts[k].symbols for k in order]), np.array(sizes)[order]
        owner, before = np.repeat(order.astype(np.int32), sizes), np.empty_like(symbols)
        before[1:] = symbols[:-1]
        before[np.cumsum(sizes) - sizes] = start
        return cls(texts, symbols, before, owner, np.cumsum(lengths) - lengths, lengths)

    def windows(self, steps: int) -> Iterator[Window]:
        for t in range(0, int(self.lengths[0]), steps):
            live = int(np.count_nonzero(self.lengths > t))
            step = np.arange(t, t + steps)[:, None]
            used = step < self.lengths[:live]
            at = np.where(used, self.starts[:live] + step, 0)
            yield Window(self.before[at], self.symbols[at], used, self.owner[at], live)


@dataclass
class Window:
    x: np.ndarray
    y: np.ndarray
    used: np.ndarray
    owner: np.ndarray  # which of texts each place belongs to
    live: int  # lanes that still run, the first ones


def dealt(texts: Iterable[Text], lanes: int, start: int) -> Iterator[Lanes]:
    """Documents, of about ``HELD`` symbols at a time, in lanes."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text.symbols) + ROW
        if size >= HELD:
            yield Lanes.of(held, lanes, start)
            held, size = [], 0
    if held:
        yield Lanes.of(held, lanes, start)


def score(texts: Iterable[Text], net: Network, steps: int = SCORE_STEPS, lanes: int = SCORE_LANES) -> Iterator[Text]:
    """The texts as they end, ``log`` being the natural logarithm of their probability."""
    for some in dealt(texts, lanes, net.symbols):
        h, sums = np.zeros((net.state, lanes), np.float32), np.zeros(len(some.texts))
        for w in some.windows(steps):
            states = net.forward(w.x, h[:, : w.live])
            sums += np.bincount(w.owner[w.used], net.log_probability(places(states, w.used), w.y[w.used]), len(sums))
            h = states[-1].copy()
        for text, log in zip(some.texts, sums.tolist(), strict=True):
            text.log = log
            yield text
        del some, text  # before the next ones are held


def repeated(symbols: Iterable[np.ndarray], least: int) -> Iterator[Text]:
    """The documents, and if they have fewer than ``least`` tokens, them again until there are as many."""
    held, seen = [], 0
    for one in symbols:
        seen += len(one)
        if seen < least:
            held.append(one)
        yield Text(one)
    total = seen
    while held and total < least:
        for one in held:
            yield Text(one)
        total += seen


def learn(texts: Iterable[Text], net: Network, steps: int = STEPS, lanes: int = LANES, rate: float = RATE) -> int:
    """Train in place; the number of tokens learnt from."""
    flat = net.packed()
    net.weights, grad = net.views(flat), np.empty_like(flat)
    adam, tokens = Adam(flat, rate), 0
    for some in dealt(texts, lanes, net.symbols):
        h = np.zeros((net.state, lanes), np.float32)
        for w in some.windows(steps):
            _, h, _ = net.gradient(w.x, w.y, w.used, h[:, : w.live], grad)
            used = int(w.used.sum())
            adam.step(grad, used / (steps * lanes))
            tokens += used
        del some
    return tokens


# --- vocabulary -------------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """The most frequent words with their counts; the first of them, and the end token as symbol 0, are symbols of the model."""

    listed: list[bytes]
    counts: np.ndarray
    ends: int
    total: int
    distinct: int
    rest_tokens: np.ndarray  # by symbol of other words
    rest_types: np.ndarray
    words: int = WORDS
    _values: tuple[pa.Array, pa.Array] | None = None

    def __post_init__(self):
        self.modelled = min(self.words, len(self.listed))
        upper = np.array([w[0] >> 4 for w in self.listed], np.int32)
        ranks = np.arange(len(self.listed), dtype=np.int32)
        self.symbol = np.where(ranks < self.modelled, ranks + 1, self.modelled + 1 + upper)
        self.log_count = np.log10(self.counts + 1.0)
        self.log_rest = np.log10(self.rest_tokens + self.rest_types + 1.0)

    def __getstate__(self):
        return self.__dict__ | {"_values": None}

    def mass(self) -> np.ndarray:
        return np.concatenate([[self.ends], self.counts[: self.modelled], self.rest_tokens]).astype(float)

    def log_base(self) -> float:
        return log10(self.total + self.distinct + 1)

    def encode(self, words: Words) -> Encoded:
        # Most words are among a few, whose table stays in the processor's caches; only the others are looked up among all.
        often, every = self.value_sets()
        ranks = pc.index_in(words.flat, value_set=often).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        seldom = np.flatnonzero(ranks < 0)
        ranks[seldom] = pc.index_in(words.flat.take(pa.array(seldom)), value_set=every).fill_null(-1).to_numpy(zero_copy_only=False)
        symbols = self.modelled + 1 + (words.first_bytes() >> 4)
        found = ranks >= 0
        symbols[found] = self.symbol[ranks[found]]
        return Encoded(ranks, symbols)

    def value_sets(self) -> tuple[pa.Array, pa.Array]:
        if self._values is None:
            every = pa.array(self.listed, pa.binary())
            self._values = (every[:OFTEN], every)
        return self._values


@dataclass
class Encoded:
    ranks: np.ndarray  # of each word among those listed, -1 for others
    symbols: np.ndarray


@dataclass
class Words:
    """The words of a batch of texts, in one array; ``ends`` has where each text's end."""

    flat: pa.Array
    ends: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        """Maximal runs of what is no ASCII white space, with A-Z lower-cased; null texts have none."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        flat, ends = lists.flatten(), lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        some = pc.greater(pc.binary_length(flat), 0)
        kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
        return cls(flat.filter(some).cast(pa.binary()), kept[ends])

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def first_bytes(self) -> np.ndarray:
        _, offsets, data = self.flat.buffers()
        if not len(self.flat):
            return np.zeros(0, np.int32)
        starts = np.frombuffer(offsets, np.int32)[self.flat.offset : self.flat.offset + len(self.flat)]
        return np.frombuffer(data, np.uint8)[starts].astype(np.int32)

    def with_ends(self, symbols: np.ndarray) -> list[np.ndarray]:
        """The symbols of each text, and the end's."""
        out = np.zeros(len(symbols) + len(self.ends), np.int32)
        out[np.arange(len(symbols)) + self.owners()] = symbols
        return np.split(out, (self.ends + np.arange(1, len(self.ends) + 1))[:-1]) if len(self.ends) else []


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``GATHERED`` bytes. Arrow makes its table of all listed words anew for each batch that is encoded."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > GATHERED:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def tokens(text: bytes) -> list[bytes]:
    """The same words of one text. Bytes, unlike strings, have no other letters and white space than ASCII's."""
    return text.lower().split()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of a column ``text``; the null word is the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        ends = 0
        told = lambda words, counts: pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])
        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_buffer().to_pybytes() if text.is_valid else b""))
                ends += 1
                if len(seen) > COUNTED:
                    yield told(list(seen), list(seen.values()))
                    seen.clear()
        yield told([*seen, None], [*seen.values(), ends])

    parts = common.map_arrow(texts.select("text"), run, "word string, n long").where("n > 0")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, words: int = WORDS, listed: int = LISTED) -> Vocabulary:
    """From a table of all counts. The driver sees the listed words and 17 rows."""
    short = counts.where(F.col("word").isNotNull() & (F.octet_length("word") <= LISTED_BYTES))
    top = short.orderBy(F.desc("n"), "word").limit(listed).toArrow()
    upper = F.conv(F.substring(F.hex(F.substring(F.encode("word", "UTF-8"), 1, 1)), 1, 1), 16, 10).cast("int")
    per = counts.groupBy(upper.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    names, numbers = [w.encode() for w in top["word"].to_pylist()], top["n"].to_numpy()
    rest_tokens, rest_types = np.zeros(REST, np.int64), np.zeros(REST, np.int64)
    for r in per:
        if r["k"] is not None:
            rest_tokens[r["k"]], rest_types[r["k"]] = r["n"], r["types"]
    for w, n in zip(names[:words], numbers.tolist()):
        rest_tokens[w[0] >> 4] -= n
        rest_types[w[0] >> 4] -= 1
    ends = next((r["n"] for r in per if r["k"] is None), 0)
    return Vocabulary(names, numbers, ends, sum(r["n"] for r in per), sum(r["types"] for r in per), rest_tokens, rest_types, words)


# --- training and scoring on Spark ------------------------------------------------------------------


def _average(parts: DataFrame) -> np.ndarray | None:
    """The mean of the vectors (part, weight, vector) by weight, summed within groups of parts first."""
    schema = "part long, weight double, vector binary"

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer()) for v in table["vector"].combine_chunks())
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN]), "weight": pa.array([float(np.sum(table["weight"].to_numpy()))]), "vector": pa.array([total.tobytes()], pa.binary())})

    for _ in range(2):
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("_group")).applyInArrow(add, schema)
    rows = parts.orderBy("part").collect()
    weight = sum(r["weight"] for r in rows)
    return sum(np.frombuffer(r["vector"]) for r in rows) / weight if weight else None


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, rate: float = RATE, least: int = LEAST_TOKENS) -> Network:
    """From all rows of columns (doc_id, text), each in one round."""
    net, context = Network.start(vocab.mass()), texts.sparkSession.sparkContext
    for k in range(rounds):
        shared = context.broadcast((vocab, net))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate / (k + 1)) -> Iterator[pa.RecordBatch]:
            vocab, net = shared.value
            mine = net.unpacked(net.packed())

            def documents() -> Iterator[np.ndarray]:
                for batch in gathered(batches):
                    words = Words.of(batch.column(0))
                    yield from words.with_ends(vocab.encode(words).symbols)

            n = learn(repeated(documents(), least), mine, rate=rate)
            if n:
                vector = (mine.packed().astype(np.float64) * n).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(n)]), pa.array([vector], pa.binary())], ["part", "weight", "vector"])

        some = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
        mean = _average(common.map_arrow(some.select("text"), run, "part long, weight double, vector binary"))
        shared.destroy()
        if mean is not None:
            net = net.unpacked(mean.astype(np.float32))
    return net


def partial_scores(texts: DataFrame, vocab: Vocabulary, net: Network) -> DataFrame:
    """row, doc_id, held_out, n_tokens, n_known, base_score and score without the words that are not listed, and these."""
    shared = texts.sparkSession.sparkContext.broadcast((vocab, net))
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "others"]
    kind = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, net = shared.value
        first, log_base, log_end = TaskContext.get().partitionId() << 33, vocab.log_base(), log10(vocab.ends + 1)

        def read() -> Iterator[Text]:
            number = first
            for batch in gathered(batches):
                words = Words.of(batch.column(2))
                encoded, owner, n = vocab.encode(words), words.owners(), batch.num_rows
                found = encoded.ranks >= 0
                logs = np.where(found, vocab.log_count[encoded.ranks], 0.0) if len(vocab.listed) else np.zeros(len(found))
                rest = encoded.symbols - vocab.modelled - 1
                within = np.where(encoded.ranks >= vocab.modelled, logs, 0.0) - np.where(rest >= 0, vocab.log_rest[np.maximum(rest, 0)], 0.0)
                known, base, inside = (np.bincount(owner, w, n) for w in (found, logs, within))
                others, at = words.flat.filter(pa.array(~found)).cast(pa.string()).to_pylist(), 0
                n_others = np.bincount(owner[~found], minlength=n).tolist()
                ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for k, symbols in enumerate(words.with_ends(encoded.symbols)):
                    row = (number, ids[k], held[k], len(symbols), int(known[k]) + (vocab.ends > 0), float(base[k]) + log_end - len(symbols) * log_base, float(inside[k]), others[at : at + n_others[k]])
                    at += n_others[k]
                    number += 1
                    yield Text(symbols, row)

        done: deque[tuple] = deque()
        for text in score(read(), net):
            *head, within, its = text.row
            done.append((*head, within + text.log / LN10, its))
            if len(done) == 512:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds, strict=True)], names)
                done.clear()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds, strict=True)], names)

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, others array<string>"
    return common.map_arrow(texts, run, schema)


def score_documents(docs: DataFrame, words: int = WORDS, listed: int = LISTED, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row; those not held out train the model."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    training = rows.where(~F.col("held_out"))
    with common.scratch(spark) as keep:
        counts = common.cut(count_words(training))
        vocab = vocabulary(counts, words, listed)
        net = train(training, vocab, rounds)
        parts = common.cut(partial_scores(rows, vocab, net))
        # Of a document only sums move on: over its listed words, and over the others as their counts are found.
        others = parts.select("row", F.explode("others").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
        logs = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)
        found = others.join(counts.select("word", F.col("n").alias("c")), "word", "left")
        more = found.select("row", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"), logs.alias("base_score"), logs.alias("score"))
        whole = parts.drop("others").unionByName(more, allowMissingColumns=True).groupBy("row")
        sums = [F.sum(c).alias(c) for c in ("n_known", "base_score", "score")]
        out = whole.agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), *sums)
        return keep(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.total).cast("long").alias("train_tokens"), "base_score", "score"))


def op12_lm_scores(spark, sf_dir: str) -> DataFrame:
    return score_documents(common.documents(spark, sf_dir))
