"""License scans: windows of normalised text compared with license templates by the Dice coefficient of word bigrams.

Newlines count as blanks, so a notice may be wrapped or stand inside a longer line. A window and a template can only
reach the threshold when the text shares enough of the template's bigrams, hence has one of its telling bigrams and
words; and a best window begins and ends with a bigram of the template, since any other at its ends only lowers the
coefficient. All three prune without losing a match. The templates are a fixed table of the code, so they are literals
of the plan and nothing is joined or shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.texts import whole

THRESHOLD = 0.8

# Notices of common licenses, as their publishers or common usage word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "This project is licensed under the terms of the MIT license.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def bigrams_of(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def least_overlap(size: int, threshold: float) -> int:
    """Fewest shared bigrams with which a line reaches the threshold against a template of `size`: the line has at
    least as many bigrams as it shares."""
    k = 0
    while 2 * k < threshold * (k + size):
        k += 1
    return k


def telling_words(bigrams: list[str], threshold: float) -> list[str]:
    """The longest words such that fewer bigrams than `least_overlap` are without any of them."""
    words: list[str] = []
    rest = list(bigrams)
    for word in sorted({w for b in bigrams for w in b.split()}, key=lambda w: (-len(w), w)):
        if len(rest) < least_overlap(len(bigrams), threshold):
            break
        words.append(word)
        rest = [b for b in rest if word not in b.split()]
    return words


def telling_bigrams(bigrams: list[str], threshold: float) -> list[str]:
    """The longest bigrams such that fewer than `least_overlap` are left without them."""
    return sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - least_overlap(len(bigrams), threshold) + 1]


def longest_window(text: str, threshold: float) -> int:
    """Most bigrams, repeated ones counted, of a window: the size bound, and what the template itself repeats."""
    size, words = len(bigrams_of(text)), re.findall("[a-z0-9]+", text.lower())
    return int((2 - threshold) * size / threshold) + len(words) - 1 - size


def _contains_any(text: Column, parts: list[str]) -> Column:
    told = F.lit(False)
    for part in parts:
        told = told | text.contains(part)
    return told


def _computed(df: DataFrame, out: str, value: Column) -> DataFrame:
    """`df` with `value` besides, computed once a row: Spark copies no expression across an explode."""
    return df.select("*", F.explode(F.array(value)).alias(out))


def _windows(grams: Column, lines: Column, form: Column, threshold: float) -> Column:
    """Windows of `grams` that reach the threshold against one template; the best has the smallest fields."""

    def measured(first: Column, last: Column) -> Column:
        window = F.slice(grams, first + 1, last - first + 1)
        shared, size = F.size(F.array_intersect(window, form["grams"])), F.size(F.array_distinct(window))
        return F.struct(shared.alias("shared"), (size + F.size(form["grams"])).alias("sizes"), first.alias("first"), last.alias("last"))

    def reaching(spans: Column) -> Column:
        scored = F.transform(spans, lambda x: F.struct(
            (x["sizes"] - 3 * x["shared"]).alias("misfit"), (-2 * x["shared"] / x["sizes"]).alias("loss"), form["at"].alias("at"),
            (x["last"] - x["first"]).alias("more"), x["first"].alias("first"),
        ))
        return F.filter(scored, lambda x: x["loss"] <= -threshold)

    def of_start(hits: Column, first: Column) -> Column:
        ends = F.filter(hits, lambda p: p.between(first + form["least"] - 1, first + form["longest"] - 1))
        return reaching(F.transform(ends, lambda last: measured(first, last)))

    hits = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda p: F.array_contains(form["grams"], F.get(grams, p)))
    # The hits are bound to a variable once, as the only item of an array.
    starts = F.flatten(F.flatten(F.transform(F.array(hits), lambda found: F.transform(found, lambda first: of_start(found, first)))))
    # A whole line may repeat itself beyond the longest window.
    return F.concat(starts, reaching(F.transform(lines, lambda x: measured(x["first"], x["last"]))))


def license_lines(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line, license, dice) for the windows of words of `docs` (doc_id, text) that reach the threshold.

    Of overlapping windows one is named: that with most shared bigrams after those of window and template that are not
    shared are taken off, so that a notice is not named after a shorter one inside it; then the greatest coefficient, the
    alphabetically first license, the shortest and the earliest. `line` is the one in which the window begins, counted
    from 0. NULL, empty and clean texts, and an empty table, give no rows; repeated rows give repeated rows.
    """
    templates = TEMPLATES if templates is None else templates
    forms = {name: grams for name, text in sorted(templates.items()) if (grams := bigrams_of(text))}
    words = sorted({w for grams in forms.values() for w in telling_words(grams, threshold)})
    pairs = sorted({b for grams in forms.values() for b in telling_bigrams(grams, threshold)})
    table = F.array(*[
        F.struct(
            F.lit(at).alias("at"), F.lit(least_overlap(len(grams), threshold)).alias("least"),
            F.lit(longest_window(templates[name], threshold)).alias("longest"), F.array(*map(F.lit, grams)).alias("grams"),
        )
        for at, (name, grams) in enumerate(forms.items())
    ])
    lowered = _computed(docs.select("doc_id", "text"), "t", F.lower(whole())).where(_contains_any(F.col("t"), words))
    spaced = _computed(lowered, "n", F.regexp_replace("t", "[^a-z0-9]+", " ")).where(_contains_any(F.col("n"), pairs))
    split = F.transform(F.split("t", "\n"), lambda x: F.filter(F.split(x, "[^a-z0-9]+"), lambda w: w != ""))
    worded = _computed(_computed(spaced, "l", split), "w", F.flatten("l")).where("size(w) >= 2")
    pair = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)))
    likely = F.filter(table, lambda f: F.size(F.array_intersect("g", f["grams"])) >= f["least"])
    found = _computed(_computed(worded, "g", pair), "forms", likely).where("size(forms) > 0")
    placed = _computed(found, "at_line", F.flatten(F.transform("l", lambda x, i: F.array_repeat(i, F.size(x)))))
    # The bigrams inside each line of two words or more.
    places = F.sequence(F.lit(0), F.size("g"))
    first = F.filter(places, lambda p: (p == 0) | (F.get("at_line", p) != F.get("at_line", p - 1)))
    last = F.filter(places, lambda p: (p == F.size("g")) | (F.get("at_line", p) != F.get("at_line", p + 1)))
    lines = F.transform(
        F.arrays_zip(first.alias("first"), last.alias("last")),
        lambda x: F.struct(x["first"].alias("first"), (x["last"] - 1).alias("last")),
    )
    ready = _computed(placed, "lines", F.filter(lines, lambda x: x["last"] >= x["first"]))
    windows = F.array_sort(F.flatten(F.transform("forms", lambda f: _windows(F.col("g"), F.col("lines"), f, threshold))))
    none = F.array().cast("array<struct<misfit:int,loss:double,at:int,more:int,first:int>>")

    def add(chosen: Column, x: Column) -> Column:
        # Two windows overlap when they share a word; a window has one word more than bigrams.
        taken = F.exists(chosen, lambda c: (c["first"] <= x["first"] + x["more"] + 1) & (x["first"] <= c["first"] + c["more"] + 1))
        return F.when(taken, chosen).otherwise(F.array_append(chosen, x))

    best = ready.select("doc_id", "at_line", F.explode(F.aggregate(windows, none, add)).alias("s"))
    name = F.element_at(F.array(*map(F.lit, forms)), F.col("s.at") + 1)
    line = F.get("at_line", F.col("s.first")).cast("bigint")
    return best.select("doc_id", line.alias("line"), name.alias("license"), (-F.col("s.loss")).alias("dice"))


def license_sql(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    """The rows of notices that fill a line each; wrapped and embedded ones are checked by the tests."""
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in (templates or TEMPLATES).items())
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    grams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    return f"""
    WITH forms AS (SELECT license, {grams} AS f FROM (SELECT license, {words.format('t')} AS w FROM (VALUES {quoted}) v(license, t))),
    lines AS (SELECT doc_id, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS line
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    grams AS (SELECT doc_id, line, {grams} AS b FROM (SELECT doc_id, line, {words.format('t')} AS w FROM lines) WHERE len(w) >= 2),
    scored AS (SELECT doc_id, line, license, CAST(2 * len(list_intersect(b, f)) AS DOUBLE) / (len(b) + len(f)) AS dice FROM grams, forms)
    SELECT doc_id, CAST(line AS BIGINT) AS line, license, dice FROM scored WHERE dice >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1"""
