"""Find licence statements: lines, blocks and word windows compared with licence templates.

Everything happens inside the row: no shuffle, and the templates are literals of
the plan (their number and size are fixed).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.llm.columns import whole

MIN_DICE = 0.8

# Rank of the first window among the candidates of a text, past any line or block.
AFTER = 1 << 30

# Words of templates that many texts of no licence have.
COMMON = frozenset("a by in is of on or the this to under was with work".split())

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any "
    "later version."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)

# Fixed values: (licence, the wording of its notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", _ISC),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", _BSD),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GPL.format(2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL.format(3)),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", _MPL),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words; none for fewer than two words."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)),
    )
    return F.when(F.size(words) >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def template_bigrams(text: str) -> list[str]:
    """The same of a template, outside Spark; templates are ASCII."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:])))


def telling_words(grams: list[str], need: int) -> list[str]:
    """Words of which one is in every set that holds ``need`` of the bigrams; long words first, common ones last."""
    left, chosen = set(grams), []
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if len(left) < need:
            break
        chosen.append(word)
        left = {g for g in left if word not in g.split()}
    return chosen


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(content: Column, known: list[tuple[str, list[str]]], min_dice: float) -> Column:
    """Statements anywhere in the words of a text: structs of best (dice, order, name) and piece, best first.

    A window begins and ends with a bigram of the template, which loses no
    statement, as any other bigram at an end only lowers the coefficient. Of
    windows that share words the best is taken. Only texts with a word without
    which no template can be reached are split into words.
    """
    low = min_dice / (2 - min_dice)
    shelf = F.array(
        *[
            F.struct(
                F.lit(-k).alias("order"),
                F.lit(name).alias("name"),
                F.lit(len(grams)).alias("n"),
                F.lit(math.ceil(low * len(grams) - 1e-9)).alias("need"),
                F.lit(math.floor(len(grams) / low + 1e-9)).alias("most"),
                F.array(*[F.lit(g) for g in grams]).alias("grams"),
            )
            for k, (name, grams) in enumerate(known)
        ]
    )
    every = sorted({g for _, grams in known for g in grams})
    telling = {w for _, grams in known for w in telling_words(grams, math.ceil(low * len(grams) - 1e-9))}
    long = {w for w in telling if len(w) > 5}
    short = sorted(telling - long)

    def told(lower: Column) -> Column:
        guard = F.lit(False)
        for word in sorted(w for w in long if not any(o != w and o in w for o in long)):
            guard = guard | F.contains(lower, F.lit(word))
        for word in short:
            guard = guard | lower.rlike(rf"{word}(?![\p{{L}}\p{{N}}])(?<![\p{{L}}\p{{N}}]{word})")
        return guard

    def of_words(units: Column) -> Column:
        words = F.transform(units, lambda u: F.regexp_extract(F.lower(u), r"^[\p{L}\p{N}]+", 0))
        pairs = _let(words, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))))
        return _let(pairs, lambda grams: of_pairs(units, grams))

    def of_pairs(units: Column, grams: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.get(grams, i).isin(every))
        found = _let(places, lambda at: F.flatten(F.transform(shelf, lambda t: _let(
            F.filter(at, lambda i: F.array_contains(t["grams"], F.get(grams, i))),
            lambda hits: F.flatten(F.transform(hits, lambda start, j: F.filter(
                F.transform(
                    F.filter(F.slice(hits, j + t["need"], t["most"]), lambda end: end - start < t["most"]),
                    lambda end: _let(
                        F.array_distinct(F.slice(grams, start + 1, end - start + 1)),
                        lambda own: F.struct(
                            (2.0 * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + t["n"])).alias("dice"),
                            t["order"].alias("order"),
                            (-start).alias("start"),
                            end.alias("end"),
                            t["name"].alias("name"),
                        ),
                    ),
                ),
                lambda m: m["dice"] >= min_dice,
            ))),
        ))))
        chosen = F.aggregate(
            F.sort_array(found, asc=False),
            F.array().cast("array<struct<dice:double,order:int,start:int,end:int,name:string>>"),
            lambda taken, m: F.when(
                F.exists(taken, lambda o: (-o["start"] <= m["end"] + 1) & (-m["start"] <= o["end"] + 1)), taken
            ).otherwise(F.concat(taken, F.array(m))),
        )
        return F.array_distinct(
            F.transform(
                chosen,
                lambda m: F.struct(
                    F.struct(m["dice"].alias("dice"), m["order"].alias("order"), m["name"].alias("name")).alias("best"),
                    F.regexp_replace(F.array_join(F.slice(units, 1 - m["start"], m["end"] + m["start"] + 2), ""), r"[^\p{L}\p{N}]+$", "").alias("piece"),
                ),
            )
        )

    units = F.regexp_extract_all(content, F.lit(r"[\p{L}\p{N}]+[^\p{L}\p{N}]*"), F.lit(0))
    return F.when(_let(F.lower(content), told), _let(units, lambda u: F.when(F.size(u) >= 2, of_words(u))))


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: tuple = TEMPLATES,
    min_dice: float = MIN_DICE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, license, dice, n_statements, licenses, statement.

    Candidates are the lines of a text and its blocks of several lines between
    blank lines. Sets of a and b bigrams can reach the coefficient d only if
    d / (2 - d) <= a / b <= (2 - d) / d; only templates within these bounds are
    compared, and a candidate outside those of all templates is not even split
    into words: a candidate with c characters has at most c / 2 bigrams, and one
    with fewer than the smallest template needs is passed over.

    Statements with other words around them, sentences of a line, notices wrapped
    over lines and commented headers are found by ``windows`` over the words of
    the whole text, with the same bounds on the number of neighbouring pairs. A
    window inside a matching line or block of the same licence is part of it.

    ``license`` and ``dice`` are the best match (ties: the template named first,
    then lines and blocks before windows, then the earlier candidate), ``statement`` its text, ``n_statements`` the
    number of distinct matching candidates and ``licenses`` the sorted distinct
    licences they match best. Without a match they are null, 0.0, null, 0 and
    empty. Null, empty and blank texts have no match. Repeated rows and null ids
    are treated like any row; other columns are ignored; an empty table gives an
    empty result.
    """
    known = [(name, template_bigrams(body)) for name, body in templates]
    shelf = F.array(
        *[
            F.struct(
                F.lit(k).alias("rank"),
                F.lit(name).alias("name"),
                F.lit(len(grams)).alias("n"),
                F.array(*[F.lit(g) for g in grams]).alias("grams"),
            )
            for k, (name, grams) in enumerate(known)
        ]
    )
    low = min_dice / (2 - min_dice)
    fewest = min(len(grams) for _, grams in known) * low
    content = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("content"))
    lines = F.split("content", r"\r?\n")
    blocks = F.filter(F.split("content", r"\r?\n[\x20\x09\x0B-\x0D]*\r?\n\s*"), lambda b: F.instr(b, "\n") > 0)
    pieces = content.select(
        "doc_id",
        "content",
        F.filter(F.array_distinct(F.concat(lines, blocks)), lambda p: F.length(p) >= 2 * fewest).alias("pieces"),
    )
    worded = pieces.select("doc_id", "content", F.transform("pieces", lambda p: F.struct(p.alias("piece"), tokens(p).alias("words"))).alias("pieces"))
    most = max(len(grams) for _, grams in known) / low
    # A text with more words than bigrams is possible only by repetition, so the
    # upper bound is applied to the distinct pairs, the lower one to the words.
    paired = worded.select(
        "doc_id",
        "content",
        F.transform(
            F.filter("pieces", lambda p: F.size(p["words"]) - 1 >= fewest),
            lambda p: F.struct(p["piece"].alias("piece"), bigrams(p["words"]).alias("grams")),
        ).alias("pieces"),
    )
    sized = paired.select("doc_id", "content", F.filter("pieces", lambda p: F.size(p["grams"]).between(fewest, most)).alias("pieces"))
    shelved = sized.withColumn("shelf", shelf)

    def best(p: Column) -> Column:
        near = F.filter(
            F.col("shelf"),
            lambda t: (F.size(p["grams"]) >= low * t["n"]) & (F.size(p["grams"]) * low <= t["n"]),
        )
        scored = F.transform(
            near,
            lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(p["grams"], t["grams"])) / (F.size(p["grams"]) + t["n"])).alias("dice"),
                (-t["rank"]).alias("order"),
                t["name"].alias("name"),
            ),
        )
        return F.array_max(scored)

    matched = shelved.select(
        "doc_id",
        "content",
        F.filter(
            F.transform("pieces", lambda p, i: F.struct(best(p).alias("best"), (-i).alias("at"), p["piece"].alias("piece"))),
            lambda m: m["best"]["dice"] >= min_dice,
        ).alias("found"),
    )

    def joined(found: Column, spread: Column) -> Column:
        own = F.filter(spread, lambda w: ~F.exists(found, lambda m: (m["best"]["name"] == w["best"]["name"]) & F.contains(m["piece"], w["piece"])))
        return F.concat(found, F.transform(own, lambda w, i: F.struct(w["best"].alias("best"), (-AFTER - i).alias("at"), w["piece"].alias("piece"))))

    spread = windows(F.col("content"), known, min_dice)
    both = _let(F.struct(F.col("found").alias("found"), spread.alias("spread")), lambda x: F.when(x["spread"].isNull(), x["found"]).otherwise(joined(x["found"], x["spread"])))
    top = matched.select("doc_id", both.alias("found")).withColumn("top", F.array_max("found"))
    return top.select(
        "doc_id",
        F.col("top")["best"]["name"].alias("license"),
        F.coalesce(F.col("top")["best"]["dice"], F.lit(0.0)).alias("dice"),
        F.size("found").cast("bigint").alias("n_statements"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("found", lambda m: m["best"]["name"])))).alias("licenses"),
        F.col("top")["piece"].alias("statement"),
    )
