"""License scans over whole texts, with DataFrame functions only.

A-Z is lower-cased, words are joined by single spaces, and an ordered list of signature rules runs over that
form. Every rule has keywords, taken from its own expression: all that it matches holds one of them as a whole
word, and it runs only in texts that do. A text without any keyword is done. So gates save time and change no
result. Overlapping detections are resolved by interval containment: a detection inside another of the
same or a better priority is dropped (of equal intervals the earlier rule stays). The sweep over the
sorted detections is linear in their number.

Base phrases (``BASE``) are counted beside the rules and keep their labels whatever the rules say.

Defined cases: null and empty texts have no words, no labels (empty strings) and score 0; the first and
last word are null where no base phrase stands; each row is scanned by itself, repeats included; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: label, main word, SPDX words (empty where the row has no identifier), full title, short name. Expressions over lower-case words joined by single spaces.
FAMILIES: tuple[tuple[str, str, str, str, str], ...] = (
    ("0bsd", "0bsd", "0bsd", "bsd zero clause license", "0bsd"),
    ("academic-free", "academic", r"afl \d(?: \d)?", r"academic free license(?: v(?:ersion)? ?\d(?: \d)?)?", r"academic free license"),
    ("agpl", "affero", r"agpl \d(?: \d)?", r"gnu affero general public license(?: v(?:ersion)? ?\d)?", r"(?:gnu )?affero (?:gpl|general public license)"),
    ("agpl", "agpl", r"agpl \d \d (?:only|or later)", r"agpl ?v?3", r"(?:gnu )?agpl(?: ?v?\d)?"),
    ("apache", "apache", r"apache [12] \d", r"apache (?:software )?licen[cs]e(?: v(?:ersion)? ?| )[12](?: [01])?", r"apache(?: (?:software|public))? licen[cs]e"),
    ("apache", "asl", "", r"asl version 2 0", r"asl 2(?: 0)?"),
    ("apsl", "apsl", r"apsl \d \d", r"apple public source license(?: version \d \d)?", r"apsl"),
    ("artistic", "artistic", r"artistic \d \d", r"artistic license(?: version)? \d(?: \d)?", r"(?:perl )?artistic license"),
    ("beerware", "beerware", r"beerware", r"the beer ?ware license revision \d+", r"beerware license"),
    ("blueoak", "blue", r"blueoak \d \d \d", r"blue oak model license \d \d \d", r"blue oak (?:model )?license"),
    ("boost", "boost", r"bsl \d \d", r"boost software license(?: version)? \d \d", r"boost (?:software )?license"),
    ("bsd", "bsd", r"bsd [1234] clause(?: \w+)?", r"(?:2|3|4|two|three|four|new|simplified|modified|revised) (?:clause )?bsd licen[cs]e", r"bsd(?: style)? licen[cs]e"),
    ("bsd", "berkeley", "", r"regents of the university of california all rights reserved", r"berkeley software distribution license"),
    ("busl", "business", r"busl \d \d", r"business source license(?: version)? \d \d", r"business source license"),
    ("bzip2", "bzip2", r"bzip2 \d \d \d", r"bzip2 and libbzip2 license", r"bzip2 license"),
    ("cc0", "cc0", r"cc0 \d \d", r"cc0 1 0 universal(?: public domain dedication)?", r"cc0(?: license)?"),
    ("cc-by", "cc", r"cc by \d \d", r"cc by [1234] \d(?: international| unported)?", r"cc by"),
    ("cc-by", "commons", "", r"creative commons attribution [1234] \d(?: international| unported)?(?: license)?", r"creative commons attribution(?: license)?"),
    ("cc-by-nc", "nc", r"cc by nc \d \d", r"cc by nc [1234] \d(?: international| unported)?", r"cc by nc"),
    ("cc-by-nc", "noncommercial", "", r"creative commons attribution noncommercial(?: [1234] \d)?", r"attribution noncommercial license"),
    ("cc-by-nc-nd", "nc", r"cc by nc nd \d \d", r"cc by nc nd [1234] \d", r"cc by nc nd"),
    ("cc-by-nc-sa", "nc", r"cc by nc sa \d \d", r"cc by nc sa [1234] \d", r"cc by nc sa"),
    ("cc-by-nd", "nd", r"cc by nd \d \d", r"cc by nd [1234] \d", r"cc by nd"),
    ("cc-by-nd", "noderivatives", "", r"creative commons attribution noderiv(?:ative)?s(?: [1234] \d)?", r"attribution noderivatives license"),
    ("cc-by-sa", "sa", r"cc by sa \d \d", r"cc by sa [1234] \d(?: international| unported)?", r"cc by sa"),
    ("cc-by-sa", "sharealike", "", r"creative commons attribution sharealike(?: [1234] \d)?", r"attribution sharealike license"),
    ("cddl", "cddl", r"cddl \d \d", r"cddl(?: version)? \d \d", r"cddl"),
    ("cddl", "distribution", "", r"common development and distribution license(?: version \d \d)?", r"common development license"),
    ("cecill", "cecill", r"cecill \w(?: \d)?", r"cecill (?:free software )?licen[cs]e(?: agreement)?", r"cecill \w"),
    ("cpl", "cpl", r"cpl \d \d", r"common public license(?: version)? \d \d", r"cpl"),
    ("curl", "curl", r"curl", r"curl license agreement", r"curl license"),
    ("eclipse", "eclipse", r"epl \d \d", r"eclipse public license(?: v(?:ersion)?)? ?\d \d", r"eclipse (?:public|distribution) license"),
    ("ecl", "educational", r"ecl \d \d", r"educational community license(?: version)? \d \d", r"educational community license"),
    ("elastic", "elastic", r"elastic \d \d", r"elastic license(?: v(?:ersion)?)? ?\d(?: \d)?", r"elastic license"),
    ("eupl", "eupl", r"eupl \d \d", r"european union public licen[cs]e(?: v ?\d \d)?", r"eupl"),
    ("fair", "fair", r"fair", r"fair license usage of the works is permitted", r"fair license"),
    ("freetype", "freetype", r"ftl", r"freetype project license", r"freetype license"),
    ("gfdl", "documentation", r"gfdl \d \d", r"gnu free documentation license(?: version \d \d)?", r"(?:gnu )?free documentation license"),
    ("gfdl", "gfdl", r"gfdl \d \d (?:only|or later)", r"gfdl(?: version)? \d \d", r"gfdl"),
    ("gpl", "general", "", r"gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: v(?:ersion)? ?[123](?: 0)?)?", r"general public licen[cs]e"),
    ("gpl", "gpl", r"gpl [123](?: 0)?(?: only| or later)?", r"gnu gpl(?: v(?:ersion)? ?| )[123]", r"(?:gnu )?gpl(?: ?v?[123])?"),
    ("hpnd", "hpnd", r"hpnd(?: \w+)?", r"historical permission notice and disclaimer", r"hpnd"),
    ("icu", "icu", r"icu", r"icu license icu 1 8 1 and later", r"icu license"),
    ("ijg", "ijg", r"ijg", r"independent jpeg group license", r"ijg license"),
    ("imagemagick", "imagemagick", r"imagemagick", r"imagemagick license", r"imagemagick"),
    ("isc", "isc", r"isc", r"internet systems consortium license", r"isc licen[cs]e"),
    ("json", "json", r"json", r"the software shall be used for good not evil", r"json license"),
    ("lgpl", "lesser", "", r"gnu lesser general public licen[cs]e(?: v(?:ersion)? ?[23](?: [01])?)?", r"lesser general public licen[cs]e"),
    ("lgpl", "library", "", r"gnu library general public licen[cs]e(?: version 2)?", r"library general public licen[cs]e"),
    ("lgpl", "lgpl", r"lgpl [23] [01](?: only| or later)?", r"gnu lgpl(?: v(?:ersion)? ?| )[23]", r"lgpl(?: ?v?[23](?: [01])?)?"),
    ("libpng", "libpng", r"libpng(?: 2 0)?", r"png reference library license", r"libpng license"),
    ("lppl", "lppl", r"lppl \d \d\w?", r"latex project public license(?: version)? \d \d", r"lppl"),
    ("mit", "mit", r"mit(?: 0)?", r"(?:the )?mit licen[cs]e(?: mit)?", r"(?:mit|expat|x11)(?: style)? licen[cs]e"),
    ("mit", "hereby", "", r"permission is hereby granted free of charge to any person obtaining a copy", r"hereby granted free of charge"),
    ("mpl", "mozilla", "", r"mozilla public licen[cs]e(?: v(?:ersion)?)? ?[12](?: [01])?", r"mozilla public licen[cs]e"),
    ("mpl", "mpl", r"mpl [12] [01]", r"mpl(?: version)? [12] [01]", r"mpl"),
    ("ms-pl", "microsoft", r"ms (?:pl|rl)", r"microsoft (?:public|reciprocal) license", r"ms pl"),
    ("mulan", "mulan", r"mulanpsl \d \d", r"mulan permissive software license(?: version)? \d", r"mulan psl"),
    ("ncsa", "ncsa", r"ncsa", r"university of illinois ncsa open source license", r"ncsa license"),
    ("odbl", "odbl", r"odbl \d \d", r"open (?:data commons )?open database license", r"odbl"),
    ("odc-by", "commons", r"odc by \d \d", r"open data commons attribution license", r"odc by"),
    ("ofl", "ofl", r"ofl \d \d(?: \w+)*", r"sil open font license(?: version)? \d \d", r"ofl"),
    ("openssl", "openssl", r"openssl", r"openssl and ssleay license", r"openssl license"),
    ("osl", "osl", r"osl \d \d", r"open software license(?: v(?:ersion)?)? ?\d \d", r"osl"),
    ("php", "php", r"php \d \d+", r"php license(?: version)? \d \d+", r"php license"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql license", r"postgresql licen[cs]e"),
    ("proprietary", "rights", "", r"all rights reserved(?: worldwide)?", r"proprietary rights license"),
    ("proprietary", "proprietary", r"licenseref proprietary", r"proprietary and confidential", r"proprietary license"),
    ("psf", "python", r"psf \d \d", r"python software foundation license(?: version)? \d", r"python (?:software foundation )?license"),
    ("public-domain", "domain", r"licenseref public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", r"public domain license"),
    ("qpl", "qpl", r"qpl \d \d", r"q public license(?: version)? \d \d", r"qpl"),
    ("ruby", "ruby", r"ruby", r"ruby s? ?license", r"ruby license"),
    ("sleepycat", "sleepycat", r"sleepycat", r"sleepycat (?:software )?license", r"sleepycat"),
    ("sspl", "sspl", r"sspl \d \d", r"server side public license(?: version)? \d", r"sspl"),
    ("unicode", "unicode", r"unicode (?:dfs|tou|3)(?: \d+)?", r"unicode license agreement", r"unicode license"),
    ("unlicense", "unlicense", r"unlicense", r"this is free and unencumbered software released into the public domain", r"(?:the )?unlicense"),
    ("unlicense", "unencumbered", "", r"this is free and unencumbered software released into the public domain", r"free and unencumbered software"),
    ("upl", "upl", r"upl \d \d", r"universal permissive license(?: v(?:ersion)?)? ?\d \d", r"upl"),
    ("vim", "vim", r"vim", r"vim license", r"vim licen[cs]e"),
    ("w3c", "w3c", r"w3c(?: \d+)?", r"w3c software (?:notice and|and document) license", r"w3c license"),
    ("wtfpl", "wtfpl", r"wtfpl", r"do what the f\w+ you want to public license", r"wtfpl"),
    ("x11", "x11", r"x11", r"x11 license from the x consortium", r"x11 license"),
    ("zlib", "zlib", r"zlib(?: acknowledgement)?", r"zlib libpng license", r"zlib licen[cs]e"),
    ("zope", "zope", r"zpl \d \d", r"zope public license(?: zpl)?(?: version)? \d \d", r"zope public license"),
)
#: label and a phrase of the license's own body or notice, ranked as a full title is.
BODIES: tuple[tuple[str, str], ...] = (
    ("agpl", r"remote network interaction use with the gnu general public license"),
    ("apache", r"you may not use this file except in compliance with the license"),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsd", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    ("cc0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("eclipse", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license"),
    ("ofl", r"the ofl allows the licensed fonts to be used studied modified and redistributed freely"),
    ("openssl", r"this product includes software developed by the openssl project"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("zlib", r"altered source versions must be plainly marked as such"),
)
#: What stands around a family's name, best priority first: the score of a detection, and the form.
NOTICE = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|governed|redistribut\w+) (?:only )?(?:under|by|with)(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)? "
FORMS = (
    (1.0, lambda spdx, title, short: rf"spdx license identifier {spdx}"),
    (0.95, lambda spdx, title, short: rf"{NOTICE}(?:{title}|{short})(?: licen[cs]e)?"),
    (0.9, lambda spdx, title, short: title),
    (0.6, lambda spdx, title, short: short),
)


#: Words that are a gate only where an expression has no other.
COMMON = frozenset("a all and any as be by for free good in into is license licence not of open or public software source terms the this to under use used version with you".split())
_DIGIT, _ANY = "\x00", "\x01"

#: The place among the forms of a full title.
TITLE = 2


def _matches(expression: str) -> list[str]:
    """Every text that an expression of this module matches, with one mark for a digit and one for what is not bounded."""

    def several(at: int) -> tuple[list[str], int]:
        done: list[str] = []
        now = [""]
        while at < len(expression) and expression[at] != ")":
            c = expression[at]
            if c == "|":
                done, now, at = done + now, [""], at + 1
                continue
            if expression.startswith("(?:", at):
                part, at = several(at + 3)
            elif c == "[":
                end = expression.index("]", at)
                part, at = list(expression[at + 1 : end]), end
            elif c == "\\":
                part, at = [{"d": _DIGIT, "w": _ANY}[expression[at + 1]]], at + 1
            elif c in "(.*+?^${":
                raise ValueError(f"{c} in {expression}")
            else:
                part = [c]
            at += 1
            sign = expression[at : at + 1]
            if sign in ("?", "*", "+"):
                part = [_ANY] if sign == "+" else ["", *part]
                at += 1
            now = [x + y for x in now for y in part]
        return done + now, at

    return several(0)[0]


def keywords_of(expression: str) -> tuple[str, ...]:
    """Words of which each text that the expression matches holds one."""
    left = [{w for w in text.split(" ") if w.strip(_DIGIT + "0123456789") and _ANY not in w} for text in _matches(expression)]
    chosen: set[str] = set()
    while left:
        counts = Counter(w for words in left for w in (words - COMMON or words))
        best = max(counts, key=lambda w: (counts[w], len(w), w))
        chosen.add(best)
        left = [words for words in left if best not in words]
    ways = [[w.replace(_DIGIT, str(d)) for d in range(10)] if _DIGIT in w else [w] for w in chosen]
    if any(w.count(_DIGIT) > 1 for w in chosen):
        raise ValueError(f"no keyword in {expression}")
    return tuple(sorted(w for way in ways for w in way))


def signature_rules() -> list[tuple[tuple[str, ...], str, str, int, float]]:
    """(keywords, expression, label, priority, score), in order: by priority, then as listed."""
    named = (lambda spdx, title, short: spdx, lambda spdx, title, short: f"{title}|{short}", lambda spdx, title, short: title, lambda spdx, title, short: short)
    listed = [
        (keywords_of(name(spdx, title, short)), rf"(?<= )(?:{form(spdx, title, short)})(?= )", label, priority, score)
        for priority, ((score, form), name) in enumerate(zip(FORMS, named, strict=True))
        for label, _, spdx, title, short in FAMILIES
        if name(spdx, title, short)
    ]
    bodies = [(keywords_of(phrase), rf"(?<= )(?:{phrase})(?= )", label, TITLE, FORMS[TITLE][0]) for label, phrase in BODIES]
    return sorted(listed + bodies, key=lambda rule: rule[3])


def _positions(text: Column, pattern: Column, make) -> Column:
    """An array of make(start, end), one for each match, in characters. Full blocks go to a list of
    lists, so that appending stays cheap however many matches there are."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, n: F.struct(g.alias("g"), n.alias("n")))
    hit = make(F.lit(0), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.filter(F.array(hit), lambda _: F.lit(False)).alias("block"), F.filter(F.array(F.array(hit)), lambda _: F.lit(False)).alias("done"))

    def step(acc: Column, x: Column) -> Column:
        one = F.array(make(acc["at"] + x["g"], acc["at"] + x["g"] + x["n"]))
        full = F.size(acc["block"]) >= 256
        return F.struct(
            (acc["at"] + x["g"] + x["n"]).alias("at"),
            F.when(full, one).otherwise(F.concat(acc["block"], one)).alias("block"),
            F.when(full, F.concat(acc["done"], F.array(acc["block"]))).otherwise(acc["done"]).alias("done"),
        )

    return F.aggregate(pairs, start, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["block"]))


def held_keywords(text: Column) -> Column:
    """The rules' keywords that are words of the normal form ``text``."""
    return F.array_intersect(F.split(text, " "), F.array(*[F.lit(k) for k in sorted({k for r in signature_rules() for k in r[0]})]))


def detections(text: Column, held: Column | None = None) -> Column:
    """The matches in the normal form ``text`` of the rules with a keyword in ``held``, or of all rules: structs (start, less_end, priority, rule, label, score), sorted so that what contains comes before what is contained."""
    listed = signature_rules()
    rules = F.array(*[F.struct(F.array(*[F.lit(k) for k in ks]).alias("keywords"), F.lit(p).alias("pattern"), F.lit(label).alias("label"), F.lit(prio).alias("priority"), F.lit(s).alias("score"), F.lit(n).alias("rule")) for n, (ks, p, label, prio, s) in enumerate(listed)])
    active = rules if held is None else F.filter(rules, lambda r: F.arrays_overlap(r["keywords"], held))

    def of_rule(r: Column) -> Column:
        return _positions(text, r["pattern"], lambda a, b: F.struct(a.alias("start"), (-b).alias("less_end"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"), r["score"].alias("score")))

    return F.sort_array(F.flatten(F.transform(active, of_rule)))


def resolve(found: Column) -> Column:
    """Sweep sorted detections: struct(labels, score, n_kept, n_suppressed) after containment suppression."""
    levels = len(FORMS)
    zero = F.struct(*[F.lit(-1).alias(f"e{p}") for p in range(levels)], F.lit(0).alias("kept"), F.lit(0).alias("dropped"), F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("labels"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["less_end"]
        inside = F.lit(False)
        for p in range(levels):
            inside = inside | ((d["priority"] >= p) & (acc[f"e{p}"] >= end))
        ends = [F.when((d["priority"] == p) & ~inside, F.greatest(acc[f"e{p}"], end)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in range(levels)]
        new = ~inside & ~F.array_contains(acc["labels"], d["label"])
        return F.struct(
            *ends,
            (acc["kept"] + F.when(inside, 0).otherwise(1)).alias("kept"),
            (acc["dropped"] + F.when(inside, 1).otherwise(0)).alias("dropped"),
            F.when(inside, acc["score"]).otherwise(F.greatest(acc["score"], d["score"])).alias("score"),
            F.when(new, F.concat(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
        )

    return F.aggregate(found, zero, step)


def _count(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("long")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(doubled: Column, n_words: Column) -> tuple[Column, Column, Column, Column]:
    """Places, first, last and labels of the base phrases, over words with two spaces between any two."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        part = " " + phrase.replace(" ", "  ") + " "
        n = _count(doubled, part)
        words_after = F.floor(_spaces(F.substring_index(doubled, part, -1)) / 2)
        counts.append(n)
        firsts.append(F.when(n > 0, F.floor(_spaces(F.substring_index(doubled, part, 1)) / 2).cast("long")))
        lasts.append(F.when(n > 0, (n_words - words_after - len(phrase.split())).cast("long")))
        labels.append(F.when(n > 0, F.lit(label)))
    total = counts[0]
    for n in counts[1:]:
        total = total + n
    return total, F.least(*firsts), F.greatest(*lasts), F.array_compact(F.array(*labels))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gated: bool = True) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_kept, n_suppressed of each row; ``gated`` only saves time."""
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    normal = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("text", common.UPPER, common.LOWER), SEPARATORS, " ")), F.lit(" "))

    def n_words(words: Column) -> Column:
        return F.when(words == "  ", 0).otherwise(_spaces(words) - 1).cast("long")

    def of(words: Column, held: Column | None) -> Column:
        def with_base(doubled: Column) -> Column:
            n, first, last, labels = _base(doubled, n_words(words))
            return F.struct(n.alias("n_base"), first.alias("first_word"), last.alias("last_word"), labels.alias("base_labels"))

        return F.struct(common.let(F.replace(words, F.lit(" "), F.lit("  ")), with_base).alias("base"), resolve(detections(words, held)).alias("rules"))

    def counted(words: Column) -> Column:
        r = common.let(held_keywords(words), lambda held: F.when(F.size(held) > 0, of(words, held))) if gated else of(words, None)
        return F.struct(n_words(words).alias("n_words"), r.alias("r"))

    found = rows.select("doc_id", common.let(normal, counted).alias("x")).select("doc_id", "x.n_words", "x.r")
    base, rules = F.col("r.base"), F.col("r.rules")
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(base["base_labels"], none)
    labels = F.array_union(base_labels, F.coalesce(rules["labels"], none))
    zero = F.lit(0).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(base["n_base"], zero).alias("n_base"),
        base["first_word"].alias("first_word"),
        base["last_word"].alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.greatest(F.coalesce(rules["score"], F.lit(0.0)), F.when(F.size(base_labels) > 0, 0.6).otherwise(0.0)).alias("score"),
        F.coalesce(rules["kept"], F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce(rules["dropped"], F.lit(0)).cast("long").alias("n_suppressed"),
    )


def op1_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir))
