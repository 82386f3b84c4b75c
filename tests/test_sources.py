"""File layouts, written by hand."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexigauge.functions.signals import with_clean_text
from lexigauge.operators.dedup import duplicate_audit
from lexigauge.plans.corpus import distinct_documents
from lexigauge.sources.files import GroupFile, load_corpus, load_for_audit, read_last_comma, read_subject_body, read_text_column
from lexigauge.sources.scratch import materialize, scratch_dir

QUOTED = '''sender,subject,body,label
a@b,"one, two","he said ""hi""
second line",1
a@b,=?UTF-8?B?w6l0w6k=?=,plain,1
a@b,,NA,1
a@b,=?broken,x,0
a@b,"one, two","he said ""hi""
second line",1
'''
UNQUOTED = "text,label\nno comma at all\none, two, three, four, five,1\nplain,0\n\n   \nleft right,1\ntext,label\n"
TEXTS = 'text,label\n"a, b",1\n,1\nNULL,0\nlast,1\n'


@pytest.fixture()
def files(tmp_path):
    for name, body in (("quoted.csv", QUOTED), ("unquoted.csv", UNQUOTED), ("texts.csv", TEXTS)):
        (tmp_path / name).write_text(body, encoding="utf-8")
    return tmp_path


def test_quoted_multi_line(spark, files):
    rows = read_subject_body(spark, f"{files}/quoted.csv").orderBy("row_no").collect()
    assert [r["raw"] for r in rows] == [
        'one, two he said "hi"\nsecond line', "été plain", " ", "=?broken x", 'one, two he said "hi"\nsecond line',
    ]


def test_last_comma(spark, files):
    rows = read_last_comma(spark, f"{files}/unquoted.csv").orderBy("row_no", "piece").collect()
    # Only the first line is a header; the same line further down is data.
    assert [r["raw"] for r in rows] == ["no comma at all", "one, two, three, four, five", "plain", "left", "right", "text"]


def test_every_file_loses_its_own_header_even_when_split(spark, tmp_path):
    lines = [f"line {i}, with comma,{i % 2}" for i in range(5000)]
    for n in range(3):
        (tmp_path / f"part{n}.txt").write_text("\n".join(["head,er", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_last_comma(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        assert df.count() == 15000 and df.where("raw like 'head%'").count() == 0
        assert df.select("file", "row_no", "piece").distinct().count() == 15000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_have_the_same_ids_however_files_are_split_and_the_first_copy_stays(spark, tmp_path):
    lines = [f"line {i % 4000}, text,1" for i in range(6000)]
    lines[3] = lines[11] = lines[5900] = "a copy,1"
    (tmp_path / "many.txt").write_text("\n".join(["text,label", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    for size in ("20000", "33333", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            docs = load_corpus(spark, [GroupFile(str(tmp_path / "many.txt"), "last_comma", "g", "o", 1)])
            rows = docs.orderBy("doc_id").collect()
            first = distinct_documents(docs).where("text = 'a copy'").select("doc_id").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [r["row_no"] for r in rows] == list(range(6000))
        assert [r["raw"] for r in rows] == [x.rsplit(",", 1)[0] for x in lines]
        assert [r["doc_id"] for r in first] == [rows[3]["doc_id"]]
        seen.append([r["doc_id"] for r in rows])
    assert seen[0] == seen[1] == seen[2]


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "six.csv").write_text('sender,receiver,date,subject,body,label\nme,you,now,Hello,World,1\n')
    (tmp_path / "turned.csv").write_text('body,label,subject\nWorld,1,Hello\n')
    for name in ("six.csv", "turned.csv"):
        assert [r["raw"] for r in read_subject_body(spark, f"{tmp_path}/{name}").collect()] == ["Hello World"]
    (tmp_path / "without.csv").write_text("title,body\na,b\n")
    with pytest.raises(ValueError, match="subject"):
        read_subject_body(spark, f"{tmp_path}/without.csv")


def test_rows_that_differ_in_microseconds_differ(spark):
    rows = spark.sql("SELECT 'g' AS g, 't' AS raw_text, 't' AS text, timestamp'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000000.0) AS at FROM range(3)")
    twins = rows.unionAll(rows.limit(1))
    found = duplicate_audit(twins, "g", ["raw_text", "at"]).first()
    assert (found["n_rows"], found["identical_rows"]) == (4, 1)


def test_text_column(spark, files):
    read = lambda audit: [r["raw"] for r in read_text_column(spark, f"{files}/texts.csv", audit=audit).orderBy("row_no").collect()]
    assert read(False) == ["a, b", "", "", "last"]
    assert read(True) == ["a, b", None, None, "last"]


def test_corpus_and_audit(spark, files):
    sources = [
        GroupFile(f"{files}/quoted.csv", "subject_body", "g1", "human", 1),
        GroupFile(f"{files}/unquoted.csv", "last_comma", "g3", "machine", 1),
        GroupFile(f"{files}/texts.csv", "text", "g4", "machine", 0),
    ]
    docs = load_corpus(spark, sources)
    assert {(r["grp"], r["origin"], r["y"], r["grp_order"]): r["n"] for r in docs.groupBy("grp", "origin", "y", "grp_order").agg(F.count("*").alias("n")).collect()} == {
        ("g1", "human", 1, 0): 5, ("g3", "machine", 1, 1): 6, ("g4", "machine", 0, 2): 4,
    }
    assert docs.select("doc_id").distinct().count() == 15
    audit = with_clean_text(load_for_audit(spark, sources).withColumnRenamed("raw", "raw_text"), "raw_text")
    rows = {r["grp"]: r for r in duplicate_audit(audit, "grp", ["row"]).collect()}
    assert (rows["g1"]["n_rows"], rows["g1"]["identical_rows"], rows["g1"]["identical_text"], rows["g1"]["unique_text"]) == (5, 1, 1, 4)
    assert (rows["g4"]["n_rows"], rows["g4"]["identical_text"], rows["g4"]["unique_text"]) == (4, 1, 2)


def session(master, shared=None):
    """As much of a session as choosing a folder needs."""
    conf = SimpleNamespace(get=lambda key, default=None: shared if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert scratch_dir(session("spark://host:7077", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077"))
    assert materialize(spark.range(5), "five").count() == 5


def test_released_tables_are_gone(spark, monkeypatch):
    from lexigauge.sources import scratch

    monkeypatch.setattr(scratch, "_written", [])
    path = scratch.new_path(spark, "some")
    spark.range(3).write.parquet(path)
    scratch.release(spark)
    assert not scratch._written
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


@pytest.mark.parametrize("layout", ["last_comma", "text"])
def test_rows_stay_and_keep_their_numbers_when_files_are_split_otherwise_later(spark, tmp_path, layout):
    """Splits depend on the cores and settings of the moment a scan runs; the loaded table does not."""
    lines = [f"row {i} of the file" for i in range(5000)]
    (tmp_path / "one.csv").write_text("\n".join(["text,label" if layout == "last_comma" else "text"] + ([f"{t},1" for t in lines] if layout == "last_comma" else lines)) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    seen = []
    try:
        for first, then in (("1m", "3k"), ("3k", "1m"), ("2k", "7k")):
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            spark.conf.set("spark.sql.files.maxPartitionBytes", first)
            if layout == "last_comma":
                loaded = read_last_comma(spark, str(tmp_path / "one.csv"))
            else:
                loaded = read_text_column(spark, str(tmp_path / "one.csv"), multi_line=False)
            spark.conf.set("spark.sql.files.maxPartitionBytes", then)
            seen.append([(r["row_no"], r["raw"]) for r in loaded.orderBy("row_no", "piece").collect()])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [raw for _, raw in seen[0]] == lines
    assert [n for n, _ in seen[0]] == list(range(seen[0][0][0], seen[0][0][0] + 5000)) and seen[0] == seen[1] == seen[2]


def test_many_splits_are_not_broadcast(spark, files, monkeypatch):
    monkeypatch.setattr("lexigauge.functions.exprs.BROADCAST_ROWS", 0)
    loaded = read_last_comma(spark, str(files / "unquoted.csv"))
    assert loaded.count() == 6
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and "rightHint" not in plan
