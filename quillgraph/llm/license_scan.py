r"""Operator 1: license scans as an exact set-similarity join of text blocks with license templates.

A block is a line of a text (split at \n), or a run of up to LINES consecutive lines of at most WIDTH bytes each, as notices stand wrapped at the head of
source files. A block matches a template T at threshold t if it holds at least ceil(t * |T|) of T's distinct tokens. Of the blocks that match a template
those are given that hold no shorter one; every longer run of lines around them matches as well.

Tokens are ordered by their global frequency, rarest first: the number of lines of the whole corpus that hold the token (ties: by text).
Prefix filter: a match must hold one of T's |T| - ceil(t|T|) + 1 rarest tokens, so only what lies around such an anchor is looked at. Length and
positional filter: if a block's first shared token is T's p-th rarest (from 0), it shares at most |T| - p tokens, and at most as many as the text has of those
that aren't rarer; both must reach ceil(t|T|). What is left is verified by counting.

Only tokens that occur in a template can decide anything. The corpus is read and tokenised once: each text is kept as the numbers of the template tokens in its lines, in a table
in the shared folder, over which frequencies are counted and blocks are matched. Templates are handled in parts of about PART_TOKENS tokens; a part's index is what is broadcast.

Defined results: lines are numbered from 0; tokens are runs of letters, digits and characters beyond ASCII in lower case, each counted once in a block.
NULL texts and texts without tokens match nothing. Repeated rows each give their own matches; repeated templates of one name are one row a distinct token set. A
template without tokens matches nothing. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import word_hashes, written

THRESHOLD = 0.8
LINES = 8
WIDTH = 160
PART_TOKENS = 1 << 20
BLOCK_BYTES = 2 << 20

#: Notices of well-known licenses as they stand in source files and pages (public texts).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("proprietary", "All rights reserved."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_SPLIT = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
SCHEMA = "doc_id long, block int, lines int, license string, template string, shared int, containment double"


def tokens(text: Column | str) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _SPLIT)), "")


def templates_frame(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates), "license string, notice string")


def hashed(words: list[str]) -> np.ndarray:
    return word_hashes(" ".join(words).encode("utf-8", "surrogatepass"))[0]


def entries(texts: list[str], known: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, its entries) of texts that hold known tokens; known: sorted hashes. An entry is (line, stretch, token), each token once a line;
    lines of one stretch may be of one block."""
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(data)
    h, start, _ = word_hashes(joined)
    if not len(h) or not len(known):
        return
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 10), len(joined))
    wide = (np.diff(np.r_[-1, ends]) - 1 > WIDTH).astype(np.int64)
    stretch = np.cumsum(wide) + np.r_[0, np.cumsum(wide)[:-1]]
    token = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = known[token] == h
    line = np.searchsorted(ends, start[hit])
    code = np.unique(line * len(known) + token[hit])
    line, token = np.divmod(code, len(known))
    first = np.concatenate(([0], np.cumsum([d.count(b"\n") + 1 for d in data])))
    doc = np.searchsorted(first, line, side="right") - 1
    out = np.stack([line - first[doc], stretch[line], token], axis=1).astype(np.int32)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in np.flatnonzero(np.diff(bounds)).tolist():
        yield d, out[bounds[d] : bounds[d + 1]]


class Index:
    """The templates of a part by their tokens' ranks (place in the global order): what each needs, and which have a rank in their prefix."""

    def __init__(self, names: list[str | None], sets: list[list[int]], texts: list[str], rank: np.ndarray, threshold: float) -> None:
        self.names, self.texts, self.rank = names, texts, rank
        self.size = np.array([len(x) for x in sets])
        self.need = np.array([math.ceil(threshold * len(x) - 1e-9) for x in sets])
        self.ranks = [np.sort(rank[np.array(x)]) for x in sets]
        prefix = [r[: n - m + 1] for r, n, m in zip(self.ranks, self.size.tolist(), self.need.tolist())]
        of = np.repeat(np.arange(len(sets)), [len(x) for x in prefix])
        at = np.concatenate(prefix)
        order = np.argsort(at, kind="stable")
        self.template = of[order]
        self.bounds = np.searchsorted(at[order], np.arange(len(rank) + 1))

    def matches(self, parts: list[np.ndarray], lines: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(number of the text, block, lines, template, shared) of texts by their entries."""
        table = np.concatenate(parts)
        doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        line, stretch, rank = table[:, 0].astype(np.int64), table[:, 1], self.rank[table[:, 2]]
        width = len(self.rank)
        held = np.unique(doc * width + rank)
        fan = self.bounds[rank + 1] - self.bounds[rank]
        some = np.flatnonzero(fan)
        anchor = np.repeat(some, fan[some])
        template = self.template[np.repeat(self.bounds[rank[some]], fan[some]) + np.arange(len(anchor)) - np.repeat(np.cumsum(fan[some]) - fan[some], fan[some])]
        not_rarer = np.searchsorted(held, (doc + 1) * width) - np.searchsorted(held, doc * width + rank)
        keep = not_rarer[anchor] >= self.need[template]
        anchor, template = anchor[keep], template[keep]
        order = np.lexsort((anchor, template, doc[anchor]))
        anchor, template = anchor[order], template[order]
        code = doc[anchor] * len(self.need) + template
        bounds = np.append(np.flatnonzero(np.r_[True, code[1:] != code[:-1]]), len(code)) if len(code) else np.zeros(1, np.int64)
        first = np.searchsorted(doc, np.arange(len(parts) + 1))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            t, d = int(template[lo]), int(doc[anchor[lo]])
            own = slice(first[d], first[d + 1])
            near = line[anchor[lo:hi]]
            at = np.minimum(np.searchsorted(near, line[own] - lines + 1), len(near) - 1)
            place = np.minimum(np.searchsorted(self.ranks[t], rank[own]), self.size[t] - 1)
            hit = (self.ranks[t][place] == rank[own]) & (np.abs(near[at] - line[own]) < lines)
            if len(np.unique(place[hit])) >= self.need[t]:
                for b, n, shared in least_blocks(line[own][hit].tolist(), stretch[own][hit].tolist(), place[hit].tolist(), int(self.need[t]), lines):
                    yield d, b, n, t, shared


def least_blocks(line: list[int], stretch: list[int], token: list[int], need: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(first line, lines, distinct tokens) of the blocks of one stretch and up to ``most`` lines that hold ``need`` distinct tokens, and no shorter one that does. Entries are in order of line."""
    count: dict[int, int] = {}
    lo, n, last = 0, len(line), -1
    for hi in range(n):
        if hi and stretch[hi] != stretch[hi - 1]:
            count, lo, last = {}, hi, -1
        count[token[hi]] = count.get(token[hi], 0) + 1
        if hi + 1 < n and line[hi + 1] == line[hi]:
            continue
        while len(count) >= need:  # the block that begins as late as it can
            end = lo
            while end <= hi and line[end] == line[lo]:
                end += 1
            fewer = dict(count)
            for x in token[lo:end]:
                fewer[x] -= 1
                if not fewer[x]:
                    del fewer[x]
            if len(fewer) < need:
                if line[lo] != last and line[hi] - line[lo] < most:
                    yield line[lo], line[hi] - line[lo] + 1, len(count)
                last = line[lo]
                break
            count, lo = fewer, end


def scan(docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES) -> DataFrame:
    """(doc_id, block, lines, license, template, shared, containment): block is the first line; template is the token set as text."""
    spark = docs.sparkSession
    notices = (templates if templates is not None else templates_frame(spark)).select("license", F.array_sort(tokens("notice")).alias("tokens")).where(F.size("tokens") > 0).distinct()
    parts = max(1, -(-(notices.agg(F.sum(F.size("tokens"))).head()[0] or 0) // PART_TOKENS))
    source = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = [_part(source, notices.where(F.pmod(F.xxhash64("tokens"), F.lit(parts)) == p).collect(), threshold, lines) for p in range(parts)]
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result


def _part(source: DataFrame, notices: list, threshold: float, lines: int) -> DataFrame:
    context = source.sparkSession.sparkContext
    notices = sorted(notices, key=lambda r: (r.license is None, r.license or "", r.tokens))
    universe = sorted({x for r in notices for x in r.tokens})
    hashes = hashed(universe)
    order = np.argsort(hashes)
    known = context.broadcast(hashes[order])
    number = {universe[i]: k for k, i in enumerate(order.tolist())}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = np.cumsum([len(x) + 1 for x in texts])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK_BYTES)))
                found = list(entries(texts[lo:hi], known.value))
                if found:
                    rows, held = zip(*found)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array([lo + d for d in rows])), pa.array([x.tobytes() for x in held], pa.binary())], names=["doc_id", "entries"])
                lo = hi

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.value), np.int64)
        for batch in batches:
            for x in batch.column("entries"):
                total += np.bincount(np.frombuffer(x.as_buffer(), np.int32)[2::3], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["token", "n"])

    held = written(source.mapInArrow(cut, "doc_id long, entries binary"), "license-entries")
    frequency = np.zeros(len(universe), np.int64)
    for r in held.select("entries").mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():  # one row a token of the part at most
        frequency[r.token] = r.n
    rank = np.empty(len(universe), np.int64)
    rank[np.lexsort((order, frequency))] = np.arange(len(universe))  # universe is sorted by text, and order is the place there
    index = context.broadcast(Index([r.license for r in notices], [[number[x] for x in r.tokens] for r in notices], [" ".join(r.tokens) for r in notices], rank, threshold)) if notices else None

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if index is None or not batch.num_rows:
                continue
            x = index.value
            rows = list(x.matches([np.frombuffer(e.as_buffer(), np.int32).reshape(-1, 3) for e in batch.column("entries")], lines))
            if rows:
                d, block, n, t, shared = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(d)),
                        pa.array(block, pa.int32()),
                        pa.array(n, pa.int32()),
                        pa.array([x.names[i] for i in t], pa.string()),
                        pa.array([x.texts[i] for i in t], pa.string()),
                        pa.array(shared, pa.int32()),
                        pa.array([round(s / int(x.size[i]), 6) for s, i in zip(shared, t)], pa.float64()),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return held.mapInArrow(match, SCHEMA)


def sql(threshold: float = THRESHOLD, lines: int = LINES) -> str:
    values = ", ".join(f"('{a}', '{b.replace(chr(39), chr(39) * 2)}')" for a, b in TEMPLATES)
    split = r"list_filter(list_distinct(regexp_split_to_array(lower({}), '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+')), lambda x: x <> '')"
    return f"""
WITH t AS (SELECT DISTINCT license, list_sort({split.format('notice')}) AS tokens FROM (VALUES {values}) v(license, notice)),
d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL),
parts AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM d),
l AS (SELECT r, doc_id, line, {split.format('part')} AS held, CASE WHEN strlen(lower(part)) > {WIDTH} THEN 1 ELSE 0 END AS wide FROM parts),
s AS (SELECT *, sum(wide) OVER w + coalesce(sum(wide) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch FROM l WINDOW w AS (PARTITION BY r ORDER BY line)),
windows AS (SELECT a.r, a.doc_id, a.line AS b, e.line AS e, list_distinct(flatten(list(m.held))) AS held
  FROM s a JOIN s e ON a.r = e.r AND a.stretch = e.stretch AND e.line BETWEEN a.line AND a.line + {lines - 1} JOIN s m ON m.r = a.r AND m.line BETWEEN a.line AND e.line GROUP BY ALL),
m AS (SELECT r, doc_id, b, e, license, tokens, len(list_intersect(held, tokens)) AS shared FROM windows, t),
good AS MATERIALIZED (SELECT * FROM m WHERE shared >= ceil(len(tokens) * {threshold} - 1e-9))
SELECT doc_id, CAST(b AS INT) AS block, CAST(e - b + 1 AS INT) AS lines, license, array_to_string(tokens, ' ') AS template, CAST(shared AS INT) AS shared,
  round(shared / len(tokens), 6) AS containment
FROM good g WHERE NOT EXISTS (SELECT 1 FROM good x WHERE x.r = g.r AND x.license = g.license AND x.tokens = g.tokens
  AND x.b >= g.b AND x.e <= g.e AND x.e - x.b < g.e - g.b)
"""
