import random
import time
import zlib

from quillgraph.llm import warc


def gz(raw):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def read(data):
    return [(type(x).__name__, x.begin, x.end) for x in warc.salvage(data)], [x.headers.get("x-page-id") for x in warc.salvage(data) if isinstance(x, warc.Record)]


A, B, C = (warc.page_bytes(i, f"http://x/{i}", f"<p>page {i} WARC/1.0 inside</p>") for i in (1, 2, 3))


def test_plain_and_packed_records():
    assert read(A + B)[1] == ["1", "2"]
    assert read(gz(A) + gz(B) + C)[1] == ["1", "2", "3"]
    assert read(gz(A + B))[1] == ["1", "2"]
    assert read(b"") == ([], [])


def test_gaps_cover_what_is_lost():
    torn = gz(B)[:-5]
    found, ids = read(gz(A) + torn + gz(C))
    assert ids == ["1", "3"] and found[1] == ("Gap", len(gz(A)), len(gz(A)) + len(torn))
    bad = bytearray(B)
    bad[-10] ^= 1
    gap = [x for x in warc.salvage(A + bytes(bad) + C) if isinstance(x, warc.Gap)]
    assert [(g.begin, g.end, g.reason) for g in gap] == [(len(A), len(A) + len(B), "wrong digest")]
    assert read(b"junk" + A + b"junk" + gz(B) + b"tail")[1] == ["1", "2"]
    assert [x[0] for x in read(b"junk" + A + b"junk" + gz(B) + b"tail")[0]] == ["Gap", "Record", "Gap", "Record", "Gap"]
    assert read(A[:-20])[0] == [("Gap", 0, len(A) - 20)]
    inside = list(warc.salvage(gz(A + bytes(bad) + C)))
    assert [type(x).__name__ for x in inside] == ["Record", "Gap", "Record"] and inside[2].inner == len(A) + len(B)


def test_every_record_survives_any_single_hit():
    """Brute force: whatever byte is changed, all other records are read, and records and gaps cover the archive."""
    for data, parts in ((A + B + C, [A, B, C]), (gz(A) + gz(B) + gz(C), [gz(A), gz(B), gz(C)])):
        for at in range(0, len(data), 7):
            hit = bytearray(data)
            hit[at] ^= 0x41
            found = list(warc.salvage(bytes(hit)))
            struck = str(1 + sum(at >= len(b"".join(parts[: i + 1])) for i in range(2)))
            ids = {x.headers.get("x-page-id") for x in found if isinstance(x, warc.Record)}
            assert {"1", "2", "3"} - {struck} <= ids
            assert sum(x.end - x.begin for x in found) == len(data)


def test_members_of_several_records_hit_at_every_byte():
    """Brute force: what is read is what was written, and all records that lie in the unchanged front of the content are read."""
    content, packed = A + B + C, gz(A + B + C)
    ends = [len(A), len(A + B), len(content)]
    for at in range(len(packed)):
        hit = bytearray(packed)
        hit[at] ^= 0x41
        inflate, front = zlib.decompressobj(31), b""
        try:
            for i in range(len(hit)):
                front += inflate.decompress(bytes(hit[i : i + 1]))
        except zlib.error:
            pass
        same = next((i for i, (x, y) in enumerate(zip(front, content)) if x != y), min(len(front), len(content)))
        found = [x for x in warc.salvage(bytes(hit) + gz(A)) if isinstance(x, warc.Record)]
        blocks = {x.headers.get("x-page-id"): x.block for x in found}
        assert all(warc.page_bytes(int(i), f"http://x/{i}", b.decode()) in content for i, b in blocks.items() if i)
        assert found[-1].begin == len(hit) and [x.inner for x in found[:-1]][: sum(e <= same for e in ends)] == [0, *ends][: sum(e <= same for e in ends)]


def test_streams_give_the_same_in_any_window():
    r = random.Random(3)
    pages = [warc.page_bytes(i, "u", "text " * r.randrange(200)) for i in range(40)]
    parts = [warc.damage(gz(x) if r.random() < 0.5 else x, i, False, 5) for i, x in enumerate(pages)] + [gz(b"".join(pages[:5])), gz(b"".join(pages[5:9]))[:-9], b"junk", gz(pages[0]), b"tail"]
    data = b"".join(parts)
    want = [(type(x), x.begin, x.end, x.inner, getattr(x, "reason", None)) for x in warc.salvage(data)]
    for window in (100, 1000, 7000, 1 << 20):
        left = [data]

        def more(n):
            out, left[0] = left[0][:n], left[0][n:]
            return out

        assert [(type(x), x.begin, x.end, x.inner, getattr(x, "reason", None)) for x in warc.salvage_stream(more, window)] == want


def test_time_is_in_proportion_to_size():
    page = gz(warc.page_bytes(1, "u", random.Random(1).randbytes(3000).hex()))

    def seconds(n):
        data, begun = page * n, time.process_time()
        assert sum(1 for _ in warc.salvage(data)) == n
        return time.process_time() - begun

    seconds(100)
    assert seconds(16_000) < 16 * max(0.05, seconds(2_000))  # 8 times the size


def test_members_whose_first_version_line_is_not_in_front():
    for junk in (b"\r\n", b"junk", b"WARX/1.1\r\n" + A[10:], bytes(3)):
        found = list(warc.salvage(gz(junk + B + C)))
        assert [x.headers["x-page-id"] for x in found if isinstance(x, warc.Record)] == ["2", "3"]
        assert [type(x).__name__ for x in found] == ["Gap"] * (junk != b"\r\n") + ["Record"] * 2
    assert read(gz(b"no record") + A)[0][0][0] == "Gap"


def test_failed_members_of_several_records():
    packed, last = gz(A + B + C), gz(C)
    wrong = bytearray(packed)
    wrong[-8] ^= 1  # CRC
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = bytearray(stored.compress(A + B + C) + stored.flush())
    stored[-8] ^= 1
    for hit in (bytes(wrong), packed[:-5], bytes(stored)):
        for more in (b"", last, A, bytes(wrong)):
            ids = read(hit + more)[1]
            assert ids == ["1", "2", "3"] + {b"": [], last: ["3"], A: ["1"]}.get(more, ["1", "2", "3"])
        found = list(warc.salvage(hit + last))
        assert [type(x).__name__ for x in found] == ["Record"] * 3 + ["Gap", "Record"] and found[3].reason.startswith("gzip")
        assert {(x.begin, x.end) for x in found[:4]} == {(0, len(hit))} and [x.inner for x in found[:4]] == [0, len(A), len(A + B), len(A + B + C)]
    # wrong data: a record without a digest can't be told to be whole, one with a digest can
    bare = b"WARC/1.1\r\nContent-Length: 1\r\nX-Page-Id: 9\r\n\r\nx\r\n\r\n"
    wrong = bytearray(gz(A + bare + B))
    wrong[-8] ^= 1
    assert read(bytes(wrong))[1] == ["1", "2"] and read(gz(A + bare + B)[:-5])[1] == ["1", "9", "2"]
    # what is inflated before the failure, over several pieces
    r = random.Random(1)
    pages = b"".join(warc.page_bytes(100 + i, "u", "".join(chr(r.randrange(32, 127)) for _ in range(900))) for i in range(40))
    half = gz(pages)[: len(gz(pages)) // 2]
    for more, after in ((b"", []), (last, ["3"])):
        ids = read(half + more)[1]
        whole = len(ids) - len(after)
        assert ids == [str(100 + i) for i in range(whole)] + after and 17 <= whole <= 21


def test_tables(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>", 0), (2, None, None, 0), (None, "u", "", 0), (95, "u", "x", 0), (96, "v", "lost" * 50, 0), (97, "w", "kept", 0), (1, "u", "<p>é</p>", 0)], "page_id long, url string, html string, shard int")
    rows = warc.read(warc.write_archives(pages.coalesce(1), records=3)).collect()
    assert sorted(((r.page_id, r.target_uri, r.payload) for r in rows), key=repr) == sorted(((r.page_id, r.url, r.html) for r in pages.collect()), key=repr)
    hit = warc.read(warc.write_archives(pages.coalesce(1), damage_every=97)).collect()
    assert [r.page_id for r in hit if r.kind == "record"] == [1, 2, None, 95, 97, 1] and len([r for r in hit if r.kind == "gap"]) == 1
    assert warc.read(warc.write_archives(pages.limit(0))).count() == 0
    assert warc.read(spark.createDataFrame([("a", None), ("b", bytearray())], "shard string, content binary")).count() == 0
    (tmp_path / "a.warc").write_bytes(A + B)
    assert warc.read(warc.read_archives(spark, str(tmp_path))).count() == 2
    (tmp_path / "b c.warc.gz").write_bytes(gz(A) + b"junk" + gz(B))
    assert sorted(map(repr, warc.read_files(spark, str(tmp_path)).collect())) == sorted(map(repr, warc.read(warc.read_archives(spark, str(tmp_path))).collect()))
