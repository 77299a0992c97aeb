import gzip
import json

from quillgraph.config import SelectedConcepts, Settings, from_dict, valid_seeds
from quillgraph.functions.ids import shard_name, snapshot_date, strip_id
from quillgraph.functions.text import clean, clean_text, decode_again, invert_abstract
from quillgraph.operators import generators
from quillgraph.plans import ingestqueries, runner
from quillgraph.schemas import raw_work
from quillgraph.sources import shards, sinks
from quillgraph.streaming import ingest

import pytest
from pyspark.sql import functions as F

WORK = {
    "id": "https://x.org/W1",
    "publication_year": 2010,
    "title": " Caf&eacute; &amp; crème ",
    "abstract_inverted_index": {"b": [1, 7], "a": [0], "clash": [1], "none": None},
    "cited_by_count": 3,
    "ids": {"doi": "10.1/x"},
    "open_access": {"is_oa": True, "oa_url": "u"},
    "primary_location": {"landing_page_url": "l", "source": {"id": "https://x.org/S1", "display_name": "J", "issn": ["1", "2"]}},
    "referenced_works": ["https://x.org/W2", "https://x.org/W1", "https://x.org/W2"],
    "authorships": [
        {"author": {"id": "https://x.org/A1"}, "author_position": "first", "is_corresponding": True, "institutions": [{"id": "https://x.org/I1", "display_name": "U", "country_code": "DE"}, {"id": "I2"}]},
        {"author": None, "author_position": "last", "institutions": []},
    ],
    "concepts": [{"id": "https://x.org/C1", "display_name": "c", "level": 1, "score": 0.5}, {"id": "C2", "score": 0.1}, {"id": "C1", "score": 0.7}, {"id": "C3", "score": None}],
}


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in" / "works" / "updated_date=2024-05-01"
    d.mkdir(parents=True)
    lines = [
        json.dumps(WORK),
        "",
        "{broken",
        "[1, 2]",
        json.dumps({"id": "W5", "publication_year": "2010"}),
        json.dumps({"id": "W6", "publication_year": 2010.7, "primary_location": {"source": {}}}),
        json.dumps({"id": "W7", "publication_year": "soon"}),
        json.dumps({"id": "W8"}),
        json.dumps({"id": "W9", "publication_year": 1990}),
        json.dumps({"id": "https://x.org/W10", "publication_year": 2010, "cited_by_count": "many"}),
    ]
    with gzip.open(d / "part_000.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(lines))
    (d / "notes.txt").write_text("not a shard")
    return tmp_path


@pytest.fixture
def parsed(spark, folder):
    return shards.parse(shards.read_lines(spark, str(folder / "in" / "works")), raw_work())


def test_states_failures_and_years(parsed, rows):
    assert rows(parsed.groupBy("state").count()) == [("failed", 2), ("malformed", 1), ("ok", 6)]
    found = {r.record_id: r for r in shards.failures(parsed).collect()}
    assert set(found) == {"W10", None} and found["W10"].shard == "updated_date=2024-05-01_part_000"
    kept = shards.works_in_range(parsed, 2005, 2024)
    assert rows(kept.select("id", "year", "snapshot_date")) == [("W5", 2010, "2024-05-01"), ("W6", 2010, "2024-05-01"), ("https://x.org/W1", 2010, "2024-05-01")]


def test_a_line_is_parsed_once(parsed):
    for df in (generators.authorships(shards.works_in_range(parsed, 2005, 2024)), shards.failures(parsed), shards.staged(parsed)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_generators(spark, parsed, rows):
    one = shards.works_in_range(parsed, 2005, 2024)
    w = generators.works(one).where("work_id = 'W1'").head()
    assert w.title == "Café & crème" and w.title_length == 12
    assert w.abstract_text == "a b b" and w.abstract_length == 5
    assert json.loads(w.ids) == {"doi": "10.1/x"} and w.source_id == "S1" and w.is_open_access
    empty = generators.works(one, True).where("work_id = 'W5'").head()
    assert (empty.title, empty.title_length, empty.abstract_text, empty.abstract_length, empty.ids, empty.abstract_inverted_index) == (None, 0, "", 0, "{}", None)
    assert rows(generators.citation_edges(one).select("cited_work_id", "citing_work_id")) == [("W1", "W1"), ("W2", "W1"), ("W2", "W1")]
    assert rows(generators.authorships(one).drop("snapshot_date")) == [("W1", "A1", "first", 0, True), ("W1", None, "last", 1, None)]
    assert rows(generators.affiliations(one).drop("snapshot_date")) == [("W1", "A1", "I1"), ("W1", "A1", "I2")]
    assert rows(generators.institutions(one).drop("snapshot_date")) == [("I1", "U", "DE"), ("I2", None, None)]
    assert rows(generators.sources(one).select("source_id", "source_name", "issn_list")) == [("S1", "J", '["1","2"]')]
    assert rows(generators.concepts(one, 0.3).drop("snapshot_date")) == [("C1", "c", 1), ("C1", None, None)]
    assert rows(generators.scores(one, 0.0).drop("snapshot_date")) == [("W1", "C1", 0.5), ("W1", "C1", 0.7), ("W1", "C2", 0.1), ("W1", "C3", None)]


def test_selected_scores(parsed, rows):
    one = shards.works_in_range(parsed, 2005, 2024)
    listed = generators.selected_scores(one, SelectedConcepts(concept_ids=("C1", "C3", "C9"))).drop("snapshot_date")
    assert rows(listed.where("work_id = 'W1'")) == [("W1", "C1", 0.7), ("W1", "C3", None), ("W1", "C9", 0.0)]
    assert rows(listed.where("work_id = 'W5'")) == [("W5", "C1", 0.0), ("W5", "C3", 0.0), ("W5", "C9", 0.0)]
    every = generators.selected_scores(one, SelectedConcepts(get_all_concepts=True)).drop("snapshot_date")
    assert rows(every) == [("W1", "C1", 0.7), ("W1", "C2", 0.1), ("W1", "C3", None)]


def test_selected_scores_of_long_lists(spark, rows):
    records = spark.range(1).selectExpr("'x/W1' id", "'d' snapshot_date", "transform(sequence(0, 59999), i -> named_struct('id', if(i % 20000 = 7, null, 'x/C' || i % 20000), 'score', double(i))) concepts")
    none = records.selectExpr("'W2' id", "snapshot_date", "slice(concepts, 1, 0) concepts").union(records.selectExpr("'W3' id", "snapshot_date", "null concepts"))
    got = rows(generators.selected_scores(records.union(none), SelectedConcepts(get_all_concepts=True)).select("work_id", "concept_id", "concept_score"))
    assert got == sorted((("W1", None if i == 7 else f"C{i}", 40_000.0 + i) for i in range(20_000)), key=repr)


def test_lines_are_written_as_they_are_made(spark):
    for lines in (ingestqueries.work_lines(spark, "/root/testdata/sf0.001"), ingestqueries.author_lines(spark, "/root/testdata/sf0.001")):
        order = lines._jdf.queryExecution().optimizedPlan().outputOrdering()
        assert order.size() and order.apply(0).child().name() == "updated_date" and not lines.schema["updated_date"].nullable  # else the writer sorts the long lines


def test_functions(spark, rows):
    df = spark.createDataFrame([("https://x.org/W1",), ("W1",), ("a/",), (None,)], "x string")
    assert [r[0] for r in df.select(strip_id("x")).collect()] == ["W1", "W1", "", None]
    paths = spark.createDataFrame([("s3://b/data/works/updated_date=2024-01-02/part_0.gz",), ("s3://b/data/authors/x/p.gz",), ("/elsewhere/p.gz",)], "x string")
    assert [r[0] for r in paths.select(shard_name("x")).collect()] == ["updated_date=2024-01-02_part_0", "x_p", None]
    assert [r[0] for r in paths.select(snapshot_date("x")).collect()] == ["2024-01-02", None, None]
    assert clean("\x1c a&lt;b  ") == "a<b" and clean(None) is None
    texts = spark.createDataFrame([(" x ",), (None,), ("",)], "t string")
    assert [r[0] for r in texts.select(clean_text("t")).collect()] == ["x", None, ""]
    maps = spark.sql("select cast(null as map<string,array<int>>) m union all select cast(map() as map<string,array<int>>) union all select map('a', array(5), 'b', array(2, 2))")
    assert [r[0] for r in maps.select(invert_abstract("m")).collect()] == ["", "", "b a"]


def test_settings():
    with pytest.raises(ValueError):
        valid_seeds(["C1", "X2"])
    assert valid_seeds(["C1", "C1"]) == ["C1"]
    with pytest.raises(ValueError):
        from_dict({"no_such": 1})
    s = from_dict({"selected_concepts": {"enabled": False}, "enabled_pipelines": ["works"], "data_path": "d"})
    assert not s.selected_concepts.enabled and s.root("tables") == "d/tables"


def test_stages_end_to_end(spark, folder, rows):
    people = folder / "in" / "authors"
    people.mkdir()
    (people / "p_2024-05-01.json").write_text(json.dumps({"id": "https://x.org/A1", "display_name": " Ann ", "works_count": 2, "summary_stats": {"h_index": 4}}) + "\n")
    s = Settings(works_input=str(folder / "in" / "works"), authors_input=str(people), data_path=str(folder / "data"), graph_filter_concepts=("C1",), selected_concepts=SelectedConcepts(concept_ids=("C1",)), global_duplicate_check=True)
    runner.run(spark, s)
    made = spark.read.parquet(f"{s.root('tables')}/works").inputFiles()
    runner.run(spark, s, ["works", "deduplication"])  # nothing new: nothing is added, no table is made again
    assert spark.read.parquet(f"{s.root('shards')}/works").count() == 3 and spark.read.parquet(f"{s.root('tables')}/works").inputFiles() == made
    per_work = spark.read.parquet(f"{s.root('metrics')}/works_metrics").collect()
    assert [(r.work_id, r.local_in_citations, r.local_out_citations, r.seed_concept_max_score, r.top_concept_id) for r in per_work] == [("W1", 1, 2, 0.7, "C1")]
    author = spark.read.parquet(f"{s.root('metrics')}/authors_metrics").head()
    assert (author.author_id, author.first_author_count, author.years_active, author.local_citation_count) == ("A1", 1, 1, 1)
    assert spark.read.parquet(f"{s.root('metrics')}/sources_metrics").head().open_access_works_count == 1
    spec = sinks.read_manifest(spark, f"{s.root('tables')}/works")
    assert spec["key"] == ["work_id"] and spec["batches"] == ["batch=000000"] and sinks.up_to_date(spark, f"{s.root('tables')}/works", spec)
    assert not sinks.up_to_date(spark, f"{s.root('tables')}/works", spec | {"rank": "another"})
    with pytest.raises(FileNotFoundError):
        sinks.require(spark, str(folder / "nothing"))
    sinks.write_bucketed(spark.range(20).withColumn("k", F.col("id")), str(folder / "b"), ["k"], 4)
    assert spark.read.parquet(str(folder / "b")).where("bucket is not null").count() == 20


def test_a_large_bucket_is_no_single_task(spark, tmp_path):
    def most_in_a_file(name):
        return max(r["count"] for r in spark.read.parquet(str(tmp_path / name)).groupBy("bucket", F.input_file_name()).count().collect())

    df = spark.range(0, 200_000, 1, 16).select(F.col("id"), F.xxhash64("id").alias("x"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        sinks.write_bucketed(df, str(tmp_path / "many"), ["id"], 2)
        assert most_in_a_file("many") < 50_000
        sinks.write_table(df.withColumn("bucket", F.lit(0)).coalesce(16), str(tmp_path / "one"), partition_by=("bucket",))
        assert most_in_a_file("one") < 50_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    sinks.write_bucketed(df, str(tmp_path / "few"), ["id"], 2)
    assert [len(list((tmp_path / "few" / f"bucket={b}").glob("*.parquet"))) for b in (0, 1)] == [1, 1]
    assert all(spark.read.parquet(str(tmp_path / x)).agg(F.sum("id"), F.count_distinct("id")).head() == (199_999 * 100_000, 200_000) for x in ("many", "one", "few"))


def shard(folder, name, *ids):
    (folder / "in" / "works" / name).write_text("\n".join(json.dumps({"id": i, "publication_year": 2010}) for i in ids))


def ids(spark, s):
    return sorted(r.work_id for x in runner.committed(spark, s, "works") for r in spark.read.parquet(f"{s.root('shards')}/works/{x}").collect())


def test_only_new_shards_are_read(spark, folder):
    s = Settings(works_input=str(folder / "in" / "works"), data_path=str(folder / "data"), selected_concepts=SelectedConcepts(enabled=False))
    runner.run(spark, s, ["works"])
    (folder / "in" / "works" / "updated_date=2024-05-01" / "part_000.gz").write_bytes(b"no gzip: reading it would fail")
    shard(folder, "b_2024-05-02.json", "W20", "W21")
    runner.run(spark, s, ["works", "deduplication"])
    assert runner.committed(spark, s, "works") == ["batch=000000", "batch=000001"] and ids(spark, s) == ["W1", "W20", "W21", "W5", "W6"]
    assert spark.read.parquet(f"{s.root('tables')}/works").count() == 5
    runner.run(spark, s, ["works"])
    assert len(runner.committed(spark, s, "works")) == 2


@pytest.mark.parametrize("fails_at", ["works", "scores", "_done_works/batch=000000"])
def test_a_run_that_breaks_off_leaves_no_second_copy(spark, folder, monkeypatch, fails_at):
    s = Settings(works_input=str(folder / "in" / "works"), data_path=str(folder / "data"), selected_concepts=SelectedConcepts(enabled=False))
    write = sinks.write_table

    def broken(df, path, *more):
        write(df, path, *more)
        if path.endswith(fails_at) or f"/{fails_at}/batch" in path:
            raise RuntimeError("killed")

    monkeypatch.setattr(sinks, "write_table", broken)
    with pytest.raises(RuntimeError):
        runner.run(spark, s, ["works"])
    monkeypatch.setattr(sinks, "write_table", write)
    shard(folder, "b_2024-05-02.json", "W20")
    runner.run(spark, s, ["works", "deduplication"])
    assert ids(spark, s) == ["W1", "W20", "W5", "W6"]
    assert spark.read.parquet(f"{s.root('shards')}/scores").count() == 2
    assert sinks.folders(spark, f"{s.root('shards')}/_parsed_works") == []


def test_batches_for_other_tables_are_made_again(spark, folder):
    s = Settings(works_input=str(folder / "in" / "works"), data_path=str(folder / "data"), selected_concepts=SelectedConcepts(enabled=False))
    runner.run(spark, s, ["works"])
    assert not sinks.folders(spark, f"{s.root('shards')}/selected_scores")
    t = Settings(works_input=s.works_input, data_path=s.data_path, selected_concepts=SelectedConcepts(concept_ids=("C1",)))
    runner.run(spark, t, ["works"])
    assert sinks.folders(spark, f"{t.root('shards')}/selected_scores") == ["batch=000000"] and ids(spark, t) == ["W1", "W5", "W6"]


def test_options_of_public_stores():
    o = Settings(max_connection_retries=7).object_store_options()
    assert o["spark.hadoop.fs.s3a.aws.credentials.provider"].endswith("AnonymousAWSCredentialsProvider") and o["spark.hadoop.fs.s3a.attempts.maximum"] == o["spark.task.maxFailures"] == "7"


def test_repair_of_texts():
    def read_wrong(text, times):
        for _ in range(times):
            text = "".join(bytes([b]).decode("cp1252", "replace").replace("\ufffd", chr(b)) for b in text.encode())
        return text

    for text in ("Café déjà vu", "Łódź ąęć šž", "Привет мир", "naïve façade €5 °C", "日本語 テキスト", "emoji 😀!", "l'œuvre ƒ"):
        assert [decode_again(read_wrong(text, n)) for n in (0, 1, 2)] == [text] * 3
    for text in ("CAFÉ”", "« É »", "ÜBER–", "Größe ß’s", "ŁÓDŹ", "Ça va? Ñ“x", "São Paulo À “B”", "ÀÉÎÕÜ àéîõü ß÷×"):
        assert decode_again(text) == text
    assert [clean(x) for x in ("ﬁn ＡＢ　x", "a\r\nb\x00", "&amp;lt;", "<b>&amp;lt;", "e\u0301", "\x1b[31mred\x1b[0m", "\x80 5", "it’s")] == ["fin AB x", "a\nb", "<", "<b>&lt;", "é", "red", "€ 5", "it's"]


def test_clean_column_is_clean(spark):
    texts = ["plain text, as it is", " x", "x\t", "a&amp;b", "a&b", "é", "e\u0301", "", "a\nb", "a\rb", "\u00a0x\u00a0", "tab\tinside", "~", "\x7f", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(clean_text("t")).collect()]
    assert got == [clean(t) for t in texts]


def test_entities_end_with_a_semicolon():
    for text in ("a&amp</title>", "a&amp", "?a=1&copy=2", "&#65 x", "&ampx; &nosuch; &am", "&;", "AT&T"):
        assert clean(text) == text
    assert [clean(x) for x in ("a&amp;amp</b>", "<&#65;&#x42;&copy;", "&CounterClockwiseContourIntegral;", "<i>&amp;amp;")] == ["a&amp</b>", "<AB©", "∳", "<i>&amp;"]


def test_long_abstracts(spark):
    n = 30_000
    words = spark.range(n).selectExpr("map_from_arrays(array('even', 'odd'), array(sequence(0, cast(id as int) * 0 + 29998, 2), sequence(1, 29999, 2))) m").limit(1)
    assert words.select(invert_abstract("m")).head()[0] == " ".join(["even", "odd"] * (n // 2))


def test_stream(spark, folder):
    s = Settings(works_input=str(folder / "in" / "works"), data_path=str(folder / "stream"), selected_concepts=SelectedConcepts(enabled=False))
    ingest.start(spark, s, str(folder / "checkpoint")).awaitTermination()
    ingest.start(spark, s, str(folder / "checkpoint")).awaitTermination()
    assert spark.read.parquet(f"{s.root('shards')}/works").count() == 3
    runner.run(spark, s, ["deduplication"])
    assert spark.read.parquet(f"{s.root('tables')}/works").count() == 3


def test_dated_parquet(spark, tmp_path):
    for name in ("a_2024-01-01", "plain"):
        spark.range(2).withColumn("work_id", F.lit(name)).select("work_id").coalesce(1).write.parquet(str(tmp_path / "raw" / name))
    import shutil

    (tmp_path / "in").mkdir()
    for name in ("a_2024-01-01", "plain"):
        shutil.copy(next((tmp_path / "raw" / name).glob("*.parquet")), tmp_path / "in" / f"{name}.parquet")
    got = shards.read_dated(spark, str(tmp_path / "in"), spark.range(0).selectExpr("'' as work_id").schema)
    assert {tuple(r) for r in got.collect()} == {("a_2024-01-01", "2024-01-01")}
