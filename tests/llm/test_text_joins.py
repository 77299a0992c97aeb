import random

import numpy as np
import pytest

from quillgraph.llm import license_scan, line_dedup, ngram_join
from quillgraph.llm.common import bucket_keys, word_hashes, words_of

MIT = "Released under the MIT License."


def test_word_hashes_are_those_of_words():
    texts = ["", "  ", "One two, ONE é-x 12\n", "a" * 70000 + " b", "…"]
    for t in texts:
        h, start, end = word_hashes(t.lower().encode())
        assert [t.lower().encode()[a:b].decode() for a, b in zip(start, end)] == words_of(t)
    h, _, _ = word_hashes(b"one two one")
    assert h[0] == h[2] != h[1]
    p, _, _ = word_hashes(b"stemming stemmed", 4)
    assert p[0] == p[1]


def test_bucket_keys_fill_all_partitions(spark):
    keys = bucket_keys(13)
    df = spark.createDataFrame([(k, b) for b, k in enumerate(keys)], "k int, b int").repartition(13, "k").selectExpr("b", "spark_partition_id() p")
    assert {(r.b, r.p) for r in df.collect()} == {(b, b) for b in range(13)}


def brute_licenses(texts, templates=license_scan.TEMPLATES, t=license_scan.THRESHOLD):
    """(doc_id, block, lines, license, shared) by trying every block."""
    want = []
    sets = {(name, tuple(sorted(set(words_of(notice))))) for name, notice in templates}
    for i, text in texts:
        lines = [] if text is None else text.split("\n")
        wide = [len(x.lower().encode()) > license_scan.WIDTH for x in lines]
        for name, tokens in sets:
            good = set()
            for b in range(len(lines)):
                held = set()
                for e in range(b, min(len(lines), b + license_scan.LINES)):
                    if e > b and (wide[b] or wide[e]):
                        break
                    held |= set(words_of(lines[e])) & set(tokens)
                    if tokens and len(held) >= t * len(tokens) - 1e-9:
                        good.add((b, e, len(held)))
            least = [(b, e, n) for b, e, n in good if not any((x, y) != (b, e) and b <= x and y <= e for x, y, _ in good)]
            want += [(i, b, e - b + 1, name, n, round(n / len(tokens), 6)) for b, e, n in least]
    return sorted(want, key=repr)


def found_licenses(df, rows):
    return rows(df.select("doc_id", "block", "lines", "license", "shared", "containment"))


GRANT = "/*\n * Permission is hereby granted, free of charge, to any person obtaining a\n * copy of this software and associated documentation files (the \"Software\")\n */\nint main"


def test_license_scan_against_counting(docs, rows):
    texts = [
        (1, f"text\n{MIT}\nreleased under an MIT license: the one"),
        (2, "All rights reserved"),
        (2, "All rights reserved"),
        (3, None),
        (4, ""),
        (None, MIT),
        (5, "word " * 3000 + MIT),
        (6, "this license is the usual one\nreleased the"),
        (7, GRANT),
        (8, "all\nrights\n\n\n\n\n\nreserved\nrights\nall"),
        (9, "all rights\n" + "x" * 200 + "\nreserved"),
        (10, "all rights\n" + "x" * 160 + "\nreserved"),
        (11, "all rights\n" + "x\n" * 7 + "reserved"),
    ]
    got = found_licenses(license_scan.scan(docs(texts)), rows)
    assert got == brute_licenses(texts) and {x[:4] for x in got if x[2] > 1} == {(7, 1, 2, "MIT"), (8, 0, 8, "proprietary"), (8, 7, 3, "proprietary"), (10, 0, 3, "proprietary")}
    assert license_scan.scan(docs([])).count() == 0


def test_license_scan_of_random_lines(docs, rows, spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    templates = [(f"L{i % 4}", some(r.randint(1, 9))) for i in range(9)] + [("none", "..."), ("L0", "w1 w2")]
    texts = [(i, "\n".join(some(r.randint(0, 4)) + " y" * r.choice([0, 0, 0, 90]) for _ in range(r.randint(1, 15)))) for i in range(60)]
    frame = spark.createDataFrame(templates, "license string, notice string")
    want = brute_licenses(texts, templates)
    assert found_licenses(license_scan.scan(docs(texts), frame), rows) == want and len(want) > 200 and sum(x[2] > 1 for x in want) > 50


def test_license_scan_in_parts_is_the_same(docs, rows, monkeypatch):
    texts = [(i, random.Random(i).choice([MIT, "All rights reserved.", "nothing here", "licensed under the CC BY-NC 4.0 terms"])) for i in range(20)]
    one = rows(license_scan.scan(docs(texts)))
    monkeypatch.setattr(license_scan, "PART_TOKENS", 40)
    assert rows(license_scan.scan(docs(texts))) == one
    empty = docs(texts).sparkSession.createDataFrame([("none", "...")], "license string, notice string")
    assert license_scan.scan(docs(texts), empty).count() == 0


def test_license_scan_of_ten_thousand_templates(docs, spark):
    r = random.Random(2)
    templates = [(f"L{i}", " ".join(f"t{r.randrange(50_000)}" for _ in range(60))) for i in range(10_000)]
    texts = [(i, "some words before\n" + templates[i * 7][1].replace(" ", "\n", 5)) for i in range(40)]
    got = license_scan.scan(docs(texts), spark.createDataFrame(templates, "license string, notice string")).collect()
    assert {(x.doc_id, x.license) for x in got} == {(i, f"L{i * 7}") for i in range(40)}


def edited(r, text, n):
    b = list(text)
    for _ in range(n):
        at = r.randrange(len(b))
        kind = r.randrange(3)
        b[at : at + (kind != 1)] = [] if kind == 0 else [r.choice("abc é")]
    return "".join(b)


@pytest.fixture(scope="module")
def line_docs():
    r = random.Random(5)
    base = ["".join(r.choice("abc é") for _ in range(r.randint(8, 60))) for _ in range(30)]
    out = [(i, "\n".join(edited(r, r.choice(base), r.randint(0, 3)) for _ in range(r.randint(1, 4)))) for i in range(60)]
    return [*out, (100, None), (101, ""), (102, out[0][1]), (102, out[0][1]), (None, out[1][1]), (103, "long " * 4000), (104, "long " * 4000 + "x"), (7, "another text of the same id, long enough")]


def brute_lines(pairs, k, least):
    """(doc, line) -> first line within k edits that comes earlier."""
    seen = []
    for i, t in sorted({p for p in pairs if p[1] is not None}, key=lambda p: (p[0] is None, p[0] or 0)):
        seen += [((i is None, i or 0, n, t), i, n, x.encode()) for n, x in enumerate(t.split("\n")) if len(x.encode()) >= least]
    seen.sort(key=lambda x: x[0][:3])
    out = {}
    for place, i, n, x in seen:
        if len(x) > 2000:
            hit = [s for s in seen if abs(len(s[3]) - len(x)) <= k and s[0][:3] < place[:3]]
        else:
            hit = [s for s in seen if s[0][:3] < place[:3] and abs(len(s[3]) - len(x)) <= k and line_dedup.plain_distance(s[3], x) <= k]
        if hit:
            out[i, n] = (hit[0][1], hit[0][2])
    return out


def line_at(pairs, r):
    return max((t.split("\n")[r.line].encode() for i, t in pairs if i == r.doc_id and t is not None and t.count("\n") >= r.line), key=len)


def test_line_dedup_against_all_pairs(docs, line_docs):
    got = {(r.doc_id, r.line): (r.kept_doc_id, r.kept_line) for r in line_dedup.duplicate_lines(docs(line_docs)).collect() if len(line_at(line_docs, r)) >= line_dedup.MIN_BYTES}
    want = brute_lines([p for p in line_docs if p[0] != 7] + [p for p in line_docs if p[0] == 7], 2, line_dedup.MIN_BYTES)
    assert set(got) == set(want) and len(got) > 20
    assert {k: v for k, v in got.items() if k[0] != 7} == {k: v for k, v in want.items() if k[0] != 7}


def test_line_dedup_of_documents(docs, rows, monkeypatch):
    a, b, c = "the first line of all, long enough", "a second line that is long enough", "a third line that is long enough too"
    texts = [(1, f"{a}\nyes\n{b}"), (2, f"{a}\n{c}"), (3, f"{a}\nyes\n{b}"), (4, "yes\nno"), (5, None), (6, ""), (7, f"{a}!\nown"), (None, c)]
    want = {1: f"{a}\nyes\n{b}", 2: c, 4: "yes\nno", 5: None, 6: "", 7: "own"}
    out = line_dedup.dedup_lines(docs(texts))
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert {r.doc_id: r.n_chars for r in out.collect()} == {i: len(t) if t is not None else None for i, t in want.items()}
    assert out.columns == docs(texts).columns
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(texts)).collect()} == want
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_short_lines_that_repeat_in_a_document_go(docs):
    a = "a line that is long enough to be compared"
    texts = [(1, "yes\nWh the.\nyes\n\n\nyes"), (2, "yes\nyes\nno\nyes"), (3, f"{a}\nno\n{a}\nno"), (4, f"{a}\nyes\nyes"), (5, "own\nown"), (5, "other\nown"), (None, "é\né\ne"), (6, "\n\n"), (7, "own\nother")]
    want = {1: {"yes\nWh the.\n\n"}, 2: {"yes\nno"}, 3: {f"{a}\nno"}, 5: {"own", "other\nown"}, None: {"é\ne"}, 6: {"\n\n"}, 7: {"own\nother"}}
    got = {}
    for r in line_dedup.dedup_lines(docs(texts)).collect():
        got.setdefault(r.doc_id, set()).add(r.text)
        assert r.n_chars == len(r.text)
    assert got == want


def test_short_repeats_against_counting(docs, line_docs):
    r = random.Random(6)
    more = [(1000 + i, "\n".join(r.choice(["yes", "no", "Les Rech.", "", "another line, and a long one"]) for _ in range(r.randint(1, 9)))) for i in range(30)]
    pairs = [p for p in line_docs if p[0] != 7] + more
    want = {k: (*v, 0) for k, v in brute_lines(pairs, 2, line_dedup.MIN_BYTES).items()}
    for i, t in pairs:
        lines = (t or "").split("\n")
        want |= {(i, n): (i, lines.index(x), 0) for n, x in enumerate(lines) if 0 < len(x.encode()) < line_dedup.MIN_BYTES and lines.index(x) < n}
    got = {(x.doc_id, x.line): (x.kept_doc_id, x.kept_line, 0) for x in line_dedup.duplicate_lines(docs(pairs)).collect()}
    assert got == want and sum(k[0] is not None and k[0] >= 1000 for k in got) > 20


def test_a_line_of_very_many_batches_is_paired_once():
    """Entries of one line from 100,000 blocks, and of one near line."""
    lines = [b"the line that stands in every document", b"the line that stands in every documend"]
    n = np.array([len(x) for x in lines])
    data, start = np.frombuffer(b"".join(lines), np.uint8), np.array([0, len(lines[0])])
    index, at, probe, probe_at = line_dedup.keys(data, start, n, 2)
    sig = line_dedup.signatures(data, start, n)
    key, line = np.concatenate([index, probe]), np.concatenate([at, probe_at])
    mark = np.arange(len(key)) < len(index)
    often = np.r_[np.tile(np.flatnonzero(line == 0), 100_000), np.flatnonzero(line == 1)]
    doc = np.arange(len(often))[::-1].copy()
    pairs = [np.stack(x[:2], axis=1) for x in line_dedup.candidates(key[often], line[often].astype(np.int64), sig[line[often]], doc, np.zeros(len(often), np.int64), mark[often], 2, 64)]
    assert sum(map(len, pairs)) <= 3 and np.unique(np.concatenate(pairs), axis=0).tolist() == [[0, 1]]


@pytest.fixture(scope="module")
def family():
    """Lines that share segments: near ones, and ones that the filters let pass but that aren't near."""
    r = random.Random(12)
    out = [f"the page with the number {i:04d} of this book" for i in range(60)]
    for _ in range(60):
        tail = list("abcdefghijkl")
        r.shuffle(tail)
        out.append("a shared beginning of lines " + "".join(tail))
    r.shuffle(out)
    return [(i // 3, "\n".join(out[i : i + 3])) for i in range(0, len(out), 3)] + [(None, "the page with the number 0007 of this boo"), (5, "the page with the number 0500 of this book")]


def test_families_of_lines_against_all_pairs(docs, family, monkeypatch):
    want = {k: v for k, v in brute_lines(family, 2, line_dedup.MIN_BYTES).items() if k[0] != 5}
    assert len(want) > 40
    for most in (1, 10**6):
        monkeypatch.setattr(line_dedup, "CANDIDATES", most)
        assert {(r.doc_id, r.line): (r.kept_doc_id, r.kept_line) for r in line_dedup.duplicate_lines(docs(family)).collect() if r.doc_id != 5} == want


def test_a_family_of_lines_costs_few_pairs():
    lines = [f"the page with the number {i:05d} of this book".encode() for i in range(20_000)]
    n = np.array([len(x) for x in lines])
    data, start = np.frombuffer(b"".join(lines), np.uint8), np.cumsum(n) - n
    index, at, probe, probe_at = line_dedup.keys(data, start, n, 2)
    sig, key, line = line_dedup.signatures(data, start, n), np.concatenate([index, probe]), np.concatenate([at, probe_at])
    rows = list(line_dedup.candidates(key, line, sig[line], line, np.zeros(len(line), np.int64), np.arange(len(key)) < len(index), 2, 64))
    assert sum(len(x[0]) for x in rows) < 20_000 * 500  # of 200 million pairs


def test_columns_with_the_names_that_are_used_inside(docs):
    texts = [(1, "the first line of all, long enough\nown"), (2, "the first line of all, long enough\nother"), (3, "one two three four five"), (4, "one two three four five")]
    more = docs(texts).selectExpr("*", "'a' as __gone", "'b' as __gone_id", "'c' as __TIE", "'d' as __id", "'e' as __gone_tie", "'f' as __seen")
    out = line_dedup.dedup_lines(more)
    assert out.columns == more.columns and {(r.doc_id, r.text, r["__gone"], r["__gone_id"], r["__TIE"]) for r in out.collect()} == {(1, texts[0][1], "a", "b", "c"), (2, "other", "a", "b", "c"), (3, texts[2][1], "a", "b", "c")}
    out = ngram_join.dedup_documents(more)
    assert out.columns == more.columns and {(r.doc_id, r["__gone_id"], r["__gone_tie"]) for r in out.collect()} >= {(1, "b", "e"), (3, "b", "e")} and out.count() == 2


@pytest.fixture(scope="module")
def copies():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(r.randint(3, 80))] for _ in range(25)]
    passage = [word() for _ in range(60)]
    out = []
    for i in range(140):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = word()
        if i % 9 == 0:
            w = w[:20] + passage + w[20:]
        out.append((i, " ".join(w)))
    out += [(200 + i, " ".join(passage)) for i in range(12)] + [(300, None), (None, "no id"), (301, ""), (302, "... !"), (303, "one"), (304, "One!"), (305, "word " * 9000), (306, "word " * 9000 + "end"), (3, out[3][1])]
    return out


def gram_set(text, n=ngram_join.N):
    w = words_of(text)
    return frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_classes(pairs, t=ngram_join.THRESHOLD):
    """Ids of each class by its set, and (class, class) -> similarity, by numbers of classes."""
    classes = {}
    for i, text in pairs:
        if i is not None and text is not None and gram_set(text):
            classes.setdefault(gram_set(text), set()).add(i)
    sets = list(classes)
    near = {(a, b): round(len(x & y) / len(x | y), 6) for a, x in enumerate(sets) for b, y in enumerate(sets) if a < b and len(x & y) / len(x | y) >= t - 1e-9}
    return [sorted(classes[x]) for x in sets], near


def brute_rows(pairs):
    ids, near = brute_classes(pairs)
    root = list(range(len(ids)))
    for _ in root:
        for a, b in near:
            low = min((root[a], root[b]), key=lambda c: ids[c][0])
            root[a] = root[b] = low
    out = set()
    for c, own in enumerate(ids):
        links = [x for k, x in near.items() if c in k]
        if len(own) > 1 or links:
            least = min(ids[d][0] for d in range(len(ids)) if root[d] == root[c])
            out |= {(i, own[0], least, len(own), len(links), max(links, default=None)) for i in own}
    return out


def result(df):
    rows = [(r.doc_id, r.class_id, r.group_id, r.copies, r.links, r.best) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("hot", [1 << 30, 4])
def test_ngram_join_against_all_pairs(docs, copies, monkeypatch, hot):
    """With a hot list too, which here holds most n-grams of the larger groups."""
    monkeypatch.setattr(ngram_join, "HOT_LEAST", hot)
    want = brute_rows(copies)
    assert result(ngram_join.join(docs(copies))) == want and sum(x[4] for x in want) > 300
    ids, near = brute_classes(copies)
    got = {(r.class_id, r.match_id, r.jaccard) for r in ngram_join.pairs(docs(copies)).collect()}
    assert got == {(*sorted((ids[a][0], ids[b][0])), x) for (a, b), x in near.items()} and len(got) > 100
    assert ngram_join.join(docs([])).count() == 0 and ngram_join.pairs(docs([])).count() == 0


def test_large_cells_in_blocks(docs, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 2)
    assert result(ngram_join.join(docs(copies))) == brute_rows(copies)


def test_one_of_each_group_stays(docs, copies):
    group = {i: g for i, _, g, *_ in brute_rows(copies)}
    stay = {i for i, _ in copies if group.get(i, i) == i}
    out = ngram_join.dedup_documents(docs(copies))
    assert {r.doc_id for r in out.collect()} == stay and out.columns == docs(copies).columns


def test_texts_of_one_doc_id_are_judged_each(docs):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "another text that nobody else has")
    out = ngram_join.dedup_documents(docs([(1, a), (3, a), (3, b), (4, b), (3, c), (3, c)]))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([(1, a), (3, b), (3, c), (3, c)])


def test_many_copies_of_one_text(docs):
    """A class of many copies travels as rows of ids, whatever its size."""
    text = "one two three four five six seven"
    rows = result(ngram_join.join(docs([(i, text) for i in range(20_000)] + [(50_000, text + " eight"), (50_001, "nothing else is like it, nothing")])))
    assert rows == {(i, 0, 0, 20_000, 1, 0.8) for i in range(20_000)} | {(50_000, 50_000, 0, 1, 1, 0.8)}


def test_divide_skip_against_counting():
    r = np.random.default_rng(3)
    for _ in range(300):
        lists = [np.unique(r.integers(0, 60, r.integers(1, 60))) for _ in range(r.integers(1, 15))]
        weights = r.integers(1, 4, len(lists)).tolist()
        least = int(r.integers(1, sum(weights) + 1))
        count = sum(np.isin(np.arange(60), x) * w for x, w in zip(lists, weights))
        got, shared = ngram_join.divide_skip(lists, weights, least)
        assert got.tolist() == np.flatnonzero(count >= least).tolist() and shared.tolist() == count[got].tolist()


def test_a_large_cell_of_near_copies_merges_few_records(monkeypatch):
    """Before, the heap merged most lists of every query: over 20 records a pair of these."""
    r = np.random.default_rng(4)
    base = np.arange(200, dtype=np.uint64)
    sets = [np.unique(np.r_[base[r.random(200) < 0.9], r.integers(1000, 4000, 12)]).astype(np.uint64) for _ in range(240)]
    sets += [np.unique(r.integers(0, 4000, 100)).astype(np.uint64) for _ in range(40)]
    sizes, side = np.array([len(s) + i % 3 for i, s in enumerate(sets)], np.int64), r.random(280) < 0.3
    merged, plain = [], ngram_join.merge_counts
    monkeypatch.setattr(ngram_join, "merge_counts", lambda lists, weights: merged.append(sum(map(len, lists))) or plain(lists, weights))
    for two in (False, True):
        for values in (ngram_join.DENSE_VALUES, 280 * 7):
            monkeypatch.setattr(ngram_join, "DENSE_VALUES", values)
            i, j, x = ngram_join.search_cell(sets, sizes, two, side, 0.45)
            shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(280) for b in range(a + 1, 280) if not two or side[a] != side[b]}
            want = {k: n / (sizes[k[0]] + sizes[k[1]] - n) for k, n in shared.items() if n / (sizes[k[0]] + sizes[k[1]] - n) >= 0.45 - 1e-9}
            assert dict(zip(zip(i.tolist(), j.tolist()), x.tolist())) == want and len(i) == len(want) > 10_000
    assert sum(merged) < 4 * 280 * 279 / 2


def test_copies_of_a_group_have_few_homes():
    """Each copy shares an n-gram of its own with one other copy; those are no homes, though half of them have lesser hashes than all of the text."""
    import pyarrow as pa

    r = np.random.default_rng(5)
    base = np.sort(r.integers(1 << 46, 1 << 47, 30).astype(np.uint64))
    sets = [np.r_[base, np.uint64(7 + i // 2 if i % 4 < 2 else (1 << 47) + i // 2)] for i in range(60)]
    df = np.r_[np.full(30, 60), 2]
    raw = ngram_join.Packed.write(np.arange(60, dtype=np.uint64), np.full(60, 31), (np.full(60, 31, np.uint32),), ngram_join.shortened(np.concatenate(sets)), np.tile(df, 60).astype(np.uint16))
    rows = pa.Table.from_batches(list(ngram_join.class_rows([pa.py_buffer(raw)], [], 0.45)))
    assert set(rows.column("home").to_pylist()) == {int(base[0])} and rows.num_rows == 60


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (101, 102), (200, 201)]
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}


def test_packed_blocks_of_many_entries(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "MOST", 3)
    owner, count, size, entry = np.array([5, 6, 7], np.uint64), np.array([7, 1, 3]), np.array([1, 2, 3], np.uint32), np.arange(11, dtype=np.uint64) << np.uint64(30)
    raw = ngram_join.Packed.write(owner, count, (size,), ngram_join.shortened(entry), np.arange(11, dtype=np.uint16))
    o, c, s, e, n = ngram_join.Packed.read(pa.py_buffer(raw), (np.uint32,), 6, np.uint16)
    assert o.tolist() == [5, 5, 5, 6, 7] and c.tolist() == [3, 3, 1, 1, 3] and s.tolist() == [1, 1, 1, 2, 3]
    assert e.tolist() == entry.tolist() and n.tolist() == list(range(11))
