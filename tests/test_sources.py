import pytest
from pyspark.sql import functions as F

from quillsieve.sources.records import read_csv_strings, read_lenient_json, read_pages, read_strict_json, require_columns, split_write, write_json_lines
from quillsieve.streaming.staging import once_per_record, stage, staged_with_alarm, windowed_counts


def test_lenient_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\nbroken\n{"x": 2}\n')
    (tmp_path / "b.jsonl").write_text("oops\n" + '{"x": 3}\n')
    (tmp_path / "c.json").write_text('[{"x": 4},\n {"x": 5}]')
    read = lambda **k: sorted(r.x for r in read_lenient_json(spark, str(tmp_path), **k).select(F.try_variant_get("record", "$.x", "int").alias("x")).collect())
    assert read() == [1, 2, 3, 4, 5]
    assert read(strict_first_line=True) == [1, 2, 4, 5]


def test_strict_json_fails(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\nbroken\n')
    with pytest.raises(Exception):
        read_strict_json(spark, str(tmp_path), "x int").collect()


def test_csv_with_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text('序号,名\n1,"甲\n乙"\n2,"说""好"""\n', encoding="utf-8-sig")
    df = read_csv_strings(spark, str(tmp_path))
    assert df.columns == ["序号", "名"]
    assert {(r.序号, r.名) for r in df.collect()} == {("1", "甲\n乙"), ("2", '说"好"')}


def test_pages_and_guard(spark, tmp_path):
    (tmp_path / "page_003.txt").write_text("三")
    (tmp_path / "page_010.txt").write_text("十\n行")
    df = read_pages(spark, str(tmp_path))
    assert {(r.page, r.text) for r in df.collect()} == {(3, "三"), (10, "十\n行")}
    with pytest.raises(ValueError):
        require_columns(df, "page", "missing")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "中", None), (2, "b", "x")], "id int, part string, v string")
    write_json_lines(df, str(tmp_path / "j"))
    lines = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert '"v":null' in lines and "中" in lines
    split_write(df, "part", str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").glob("part=*")} == {"part=b", "part=中"} or len(list((tmp_path / "s").glob("part=*"))) == 2


def test_staging_resumes(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(10).write.parquet(source)
    stage(spark, source, target, state)
    spark.range(10, 15).write.mode("append").parquet(source)
    stage(spark, source, target, state)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(15))


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i % 6, f"2024-01-01 00:{i:02d}:00", "ab"[i % 2]) for i in range(12)]
    spark.createDataFrame(rows, "k int, at string, g string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("k int, at timestamp, g string").parquet(source)

    def run(df, name):
        df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    assert sorted(r.k for r in run(once_per_record(stream(), "k", "at", "1 hour"), "once")) == list(range(6))
    counts = run(windowed_counts(stream(), "at", "5 minutes", "0 seconds", "g"), "windows")
    assert sum(r["rows"] for r in counts) == 10  # the last window is still open
    alarms = staged_with_alarm(stream(), str(tmp_path / "out"), str(tmp_path / "state"), F.col("g") == "a", 0.4)
    assert alarms == [{"batch": 0, "rows": 12, "bad": 6}]


def test_sources_by_config(spark, tmp_path):
    from quillsieve.operators.normalize import normalize_records
    from quillsieve.sources.records import read_id_list, read_sources, write_csv

    (tmp_path / "a.jsonl").write_text(
        '{"data": ["问：头痛怎么办", "您好\\n答: 先休息"]}\n{"data": ["问：", "答：好"]}\n{"data": ["只有一个"]}\n'
        '{"instruction": " 看舌 ", "input": "苔黄", "output": "热"}\n{"instruction": "Same", "input": "same", "answer": 5}\n'
        '{"Instruction": "大写", "Output": "答", "system_prompt": "自己的"}\n{"query": " ", "prompt": "后备", "response": "", "target": "有"}\n'
        '[1, 2]\n"text"\n{"query": "没有回答"}\nbroken\n',
        encoding="utf-8",
    )
    (tmp_path / "b.json").write_text('[{"question": "数组", "answer": "一"}]', encoding="utf-8")
    config = [
        {"name": "a", "path": str(tmp_path / "a.jsonl"), "track": "x"},
        {"name": "off", "path": str(tmp_path / "a.jsonl"), "disabled": True},
        {"name": "gone", "path": str(tmp_path / "none.jsonl")},
        {"name": "b", "path": str(tmp_path / "b.json"), "system": "来源的"},
    ]
    rows, missing = read_sources(spark, config)
    done = normalize_records(rows.withColumnRenamed("system", "own"), "record", F.coalesce("own", F.lit("默认")))
    found = sorted((r.name, r.system, r.messages[0].content, r.messages[1].content) for r in done.collect())
    assert missing == ["gone"] and found == sorted(
        [
            ("a", "默认", "头痛怎么办", "您好\n先休息"),
            ("a", "默认", "看舌\n苔黄", "热"),
            ("a", "默认", "Same", "5"),
            ("a", "自己的", "大写", "答"),
            ("a", "默认", "后备", "有"),
            ("b", "来源的", "数组", "一"),
        ]
    )
    (tmp_path / "ids.txt").write_text("3\n\n 4 \nx\n3\n")
    assert sorted(r.id for r in read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == [3, 4]
    write_csv(spark.createDataFrame([(1, "甲", "多")], "`序号` int, `名` string, `多余` string"), str(tmp_path / "out"), ["名", "序号"])
    written = next((tmp_path / "out").glob("*.csv")).read_text(encoding="utf-8")
    assert written.startswith("\ufeff名,序号") and read_csv_strings(spark, str(tmp_path / "out")).columns == ["名", "序号"]


def test_strict_schema(spark):
    from quillsieve.operators.normalize import strict_schema

    df = spark.createDataFrame([("a", "s", [], "L", 2), (None, "s", [], "L", 1), (None, "s", [], "M", 5), (None, None, None, "L", 9)], "id string, system string, messages array<string>, label string, at int").withColumn("extra", F.lit(1))
    out = strict_schema(df, "label", "at")
    assert out.columns == ["id", "system", "messages"] and sorted(r.id for r in out.collect()) == ["L_0", "L_2", "M_0", "a"]


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from quillsieve.session import cut_lineage, drop_cut_tables, shared_folder

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    assert cut_lineage(spark.range(3)).count() == 3 and drop_cut_tables(spark) >= 1 and drop_cut_tables(spark) == 0
