"""License scan: ordered signature rules with keyword prefilter, priority and containment.

Only DataFrame functions are used.  A text is reduced to its lower-case words joined by
single spaces, so every rule is a regular expression over whole words.  One pass asks for
any keyword at all; a text with one is then tried against the rules of the keywords it
holds, and only those.  Whatever a rule fits holds one of its keywords.  Detections are intervals of words.  Sorted by start, longest
first, a detection is suppressed when an earlier one of the same or a higher priority
contains it.

Rules are families of hand-written phrasings times license names and versions, so the
table is built from these lists.  Priorities: 3 names a license with version or a phrase
of its grant, 2 names a license, 1 hints at licensing.  Priority 3 of the base phrases
makes base places whole: they are counted over all rules of that phrase, suppressed or
not.

Defined results: null and empty texts have no words, score 0 and empty labels; repeated
rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.common import words

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Rule:
    label: str
    #: Words of which every match holds one; one that ends in * stands for all words that begin so.
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    confidence: float


#: label, keyword, how the license is named, versions.
NAMED = [
    ("mit", "mit", "mit", ()), ("mit", "expat", "expat", ()),
    ("apache", "apache", "apache(?: software)?", ("1 0", "1 1", "2", "2 0")),
    ("gpl", "gpl", "gpl", ("1", "2", "3")), ("gpl", "gnu", "gnu general public", ("1", "2", "3")),
    ("lgpl", "lgpl", "lgpl", ("2", "2 1", "3")), ("lgpl", "gnu", "gnu (?:lesser|library) general public", ("2", "2 1", "3")),
    ("agpl", "agpl", "agpl", ("1", "3")), ("agpl", "affero", "(?:gnu )?affero general public", ("1", "3")),
    ("gfdl", "gnu", "gnu free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", "mozilla public", ("1 0", "1 1", "2 0")), ("mpl", "mpl", "mpl", ("1 1", "2 0")),
    ("epl", "eclipse", "eclipse public", ("1 0", "2 0")), ("epl", "epl", "epl", ("1 0", "2 0")),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")), ("cddl", "distribution", "common development and distribution", ("1 0", "1 1")),
    ("cpl", "common", "common public", ("1 0",)), ("eupl", "eupl", "eupl", ("1 1", "1 2")),
    ("bsd", "bsd", "(?:(?:2|3|4|two|three|four) clause |simplified |modified |new |original )?bsd", ()),
    ("isc", "isc", "isc", ()), ("zlib", "zlib", "zlib(?: libpng)?", ()), ("boost", "boost", "boost software", ("1 0",)),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")), ("ofl", "sil", "sil open font", ("1 0", "1 1")),
    ("python", "python", "python software foundation", ("2",)), ("php", "php", "php", ("3 0", "3 01")),
    ("ms-pl", "microsoft", "microsoft public", ()), ("ms-rl", "microsoft", "microsoft reciprocal", ()),
    ("unlicense", "unlicense", "(?:the )?unlicense", ()), ("wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("osl", "open", "open software", ("2 1", "3 0")), ("afl", "academic", "academic free", ("2 1", "3 0")),
    ("ecl", "educational", "educational community", ("1 0", "2 0")), ("postgresql", "postgresql", "postgresql", ()),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa", ()), ("vim", "vim", "vim", ()), ("zpl", "zope", "zope public", ("2 0", "2 1")),
]
#: Creative commons: label, letters and words of each variant.
COMMONS = [
    ("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"), ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
]
#: label, keywords, text of a grant.
GRANTS = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("gpl", "gnu", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("proprietary", "reserved", "all rights reserved"), ("proprietary", "confidential", "confidential and proprietary"),
    ("boost", "boost", "distributed under the boost software license"),
    ("no-ai", "train training", "(?:may|must) not be used (?:for|to) (?:train|training)(?: of)? (?:ai|machine learning)"),
]
HINTS = [
    ("license-notice", "licensed", "licensed under"), ("license-notice", "licensed released", "(?:this|the) (?:work|software|file) is (?:licensed|released) under"),
    ("license-notice", "released", "released under (?:the|a) [^ ]+ licen[cs]e"), ("license-notice", "spdx", "spdx license identifier"),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}"),
]


def rules() -> list[Rule]:
    out = [Rule(label, (phrase.split()[2 if label == "mit" else 0],), phrase, 3, 1.0) for phrase, label in BASE.items()]
    for label, keyword, name, versions in NAMED:
        # a name of one word may be glued to its version: gplv3, lgplv2 1
        glued = bool(versions) and name.split("(?:")[0] == keyword
        keys = (f"{keyword}*" if glued else keyword,)
        for v in versions:
            tagged = f"{label}-{v.replace(' 0', '').replace(' ', '.')}"
            number = rf"(?:v ?|version ?|ver ?)?{v}"
            named = rf"(?:{name}(?: licen[cs]e)? |{keyword}){number}" if glued else rf"{name}(?: licen[cs]e)? {number}"
            full = rf"{name} licen[cs]e (?:v|version) {v}"
            full = rf"(?:{full}|{keyword}{number}(?: licen[cs]e)?)" if glued else full
            out += [
                Rule(tagged, keys, named, 3, 0.9),
                Rule(tagged, keys, rf"{full}(?: or (?:any )?later(?: version)?)", 3, 0.95),
                Rule(tagged, keys, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?{named}", 3, 1.0),
            ]
        out += [
            Rule(label, (keyword,), rf"{name} licen[cs]e", 2, 0.7),
            Rule(label, (keyword,), rf"licen[cs]e(?: is)? {name}", 2, 0.6),
            Rule(label, (keyword,), rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?", 2, 0.9),
        ]
    for label, letters, spelled in COMMONS:
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out += [
                Rule(f"{label}-{v.replace(' ', '.')}", ("cc",), rf"cc {letters} {v}", 3, 1.0),
                Rule(f"{label}-{v.replace(' ', '.')}", ("creative",), rf"creative commons {spelled} {v}", 3, 1.0),
            ]
        out += [Rule(label, ("cc",), rf"cc {letters}", 2, 0.8), Rule(label, ("creative",), rf"creative commons {spelled}", 2, 0.8)]
    out += [Rule(label, tuple(keys.split()), text, 3, 0.9) for label, keys, text in GRANTS]
    out += [Rule(label, tuple(keys.split()), text, 1, 0.3) for label, keys, text in HINTS]
    return out


def _whole(pattern: str) -> str:
    """The pattern over whole words of a text whose words each have one space on either side."""
    return f"(?<= )(?:{pattern})(?= )"


def _places(padded: Column, pattern: Column | str, fields: list[Column]) -> Column:
    """Word intervals of all matches, with the rule's fields: array of struct."""
    before = F.split(padded, pattern)
    found = F.regexp_extract_all(padded, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(0))
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + spaces(pair["before"]) - 1
        end = start + spaces(pair["match"])
        place = F.struct(start.alias("start"), (-end).alias("neg_end"), *fields)
        return F.struct((end + 1).alias("at"), F.concat(acc["out"], F.array(place).cast(PLACES)).alias("out"))

    pairs = F.zip_with(F.slice(before, 1, F.size(found)), found, lambda b, m: F.struct(b.alias("before"), m.alias("match")))
    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


#: start and end are words from 0, both included; negated so that a plain sort puts the
#: longest of the highest priority first.
PLACES = "array<struct<start:int,neg_end:int,neg_priority:int,confidence:double,label:string>>"


def sought(keyword: str) -> str:
    """A keyword as it stands in a text whose words each have one space on either side."""
    return f" {keyword[:-1]}" if keyword.endswith("*") else f" {keyword} "


def detections(padded: Column) -> Column:
    """All places of all rules of which the text holds a keyword, in suppression order."""
    table = rules()
    sets = sorted({r.keywords for r in table})
    rule = lambda r: F.struct(
        F.lit(_whole(r.pattern)).alias("pattern"), F.lit(-r.priority).alias("neg_priority"),
        F.lit(r.confidence).alias("confidence"), F.lit(r.label).alias("label"))
    by_keyword = F.array(*[
        F.struct(F.array(*[F.lit(sought(k)) for k in keys]).alias("keywords"), F.array(*[rule(r) for r in table if r.keywords == keys]).alias("rules"))
        for keys in sets])
    holds = lambda k: F.exists(k["keywords"], lambda word: F.contains(padded, word))
    held = F.flatten(F.transform(F.filter(by_keyword, holds), lambda k: k["rules"]))
    found = F.transform(held, lambda r: _places(padded, r["pattern"], [r["neg_priority"], r["confidence"], r["label"]]))
    return F.sort_array(F.flatten(found))


def suppress(places: Column) -> Column:
    """Drop a place contained in an earlier one of the same or a higher priority.

    One pass: of each priority, the furthest end so far is all that matters.
    """
    far = F.array(F.lit(-1), F.lit(-1), F.lit(-1))
    zero = F.struct(far.alias("far"), F.array().cast(PLACES).alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        priority, end = -d["neg_priority"], -d["neg_end"]
        inside = F.exists(F.slice(acc["far"], priority, 4 - priority), lambda e: e >= end)
        reach = F.transform(acc["far"], lambda e, i: F.when(i + 1 == priority, F.greatest(e, end)).otherwise(e))
        return F.struct(
            F.when(inside, acc["far"]).otherwise(reach).alias("far"),
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"))

    return F.aggregate(places, zero, step, lambda acc: acc["kept"])


def scan_licenses(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, base places, labels, score and the kept detections, per row of `documents`."""
    any_keyword = " (?:" + "|".join(sorted({sought(k)[1:] for r in rules() for k in r.keywords})) + ")"
    padded = documents.select("doc_id", words(F.col("text")).alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"),
        F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("padded"))
    gate = F.col("padded").rlike(any_keyword)
    none = F.array().cast(PLACES)
    base_rows = [
        F.when(F.contains("padded", F.lit(f" {phrase} ")),
               _places(F.col("padded"), _whole(phrase), [F.lit(-3), F.lit(1.0), F.lit(label)])).otherwise(none)
        for phrase, label in BASE.items()]
    found = padded.select(
        "doc_id", "n_words",
        F.when(gate, F.concat(*base_rows)).otherwise(none).alias("base"),
        F.when(gate, suppress(detections(F.col("padded")))).otherwise(none).alias("found"))
    names = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*c))), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").cast("bigint").alias("first_word"),
        F.array_max("base.start").cast("bigint").alias("last_word"),
        names(F.col("base.label")).alias("base_labels"), names(F.col("base.label"), F.col("found.label")).alias("labels"),
        F.coalesce(F.array_max("found.confidence"), F.lit(0.0)).alias("score"),
        F.transform("found", lambda d: F.struct(
            d["start"].alias("first"), (-d["neg_end"]).alias("last"), d["label"].alias("label"))).alias("detections"))
