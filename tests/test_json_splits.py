"""Array files read in splits of any size give the elements of a whole parse."""

import json
import random

import numpy as np
import pytest

from quarry.sources import feeds as FD
from quarry.sources import json_splits as JS


def value(r, depth=0):
    kind = r.randrange(6 if depth < 3 else 4)
    if kind < 2:
        return "".join(r.choices('ab{}[],:"\\ \n\té', k=r.randrange(12)))
    if kind < 4:
        return r.choice([None, True, 1.5, -3])
    if kind == 4:
        return [value(r, depth + 1) for _ in range(r.randrange(4))]
    return {"".join(r.choices('ab{]"', k=2)): value(r, depth + 1) for _ in range(r.randrange(4))}


def objects(r, n):
    return [{"url": f"u{k}", "issue": value(r), "more": value(r)} for k in range(n)]


def parsed(spark, path):
    elements, files = JS.read_elements(spark, [str(path)])
    rows = sorted((r["file"].rsplit("/", 1)[-1], r["ordinal"], json.loads(r["line"])) for r in elements.collect())
    return rows, {r["file"].rsplit("/", 1)[-1]: r["kind"] for r in files.collect()}


@pytest.mark.parametrize("split", [250, 1 << 20])
def test_elements_of_any_split(spark, workdir, split):
    r = random.Random(split)
    data = {"one": objects(r, 60), "flat": objects(r, 40), "many": objects(r, 30), "empty": [], "mixed": [1, "a]b", [1, [2]], {"x": "}{"}, None]}
    single = {"issue": "a,}b", "more": [1, {"b": ",["}], "z": {"y": "\\"}}
    text = {"one": json.dumps(data["one"], indent=2, ensure_ascii=False), "flat": json.dumps(data["flat"], separators=(",", ":")), "empty": "[ \n]", "mixed": json.dumps(data["mixed"]),
            "many": json.dumps(data["many"][:10]) + "\n" + json.dumps(data["many"][10:11]) + json.dumps(data["many"][11:]), "single": json.dumps(single, indent=1),
            "lines": "\n".join(map(json.dumps, data["one"])), "cut": json.dumps(data["one"])[:-1], "word": "[1] x", "open": '["a]', "deep": "[1]]"}
    for name, t in text.items():
        with open(f"{workdir}/{name}", "w") as f:
            f.write(t)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows, kinds = parsed(spark, workdir)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert kinds == {"one": "array", "flat": "array", "empty": "array", "mixed": "array", "many": "arrays", "single": "object", **dict.fromkeys(("lines", "cut", "word", "open", "deep"), "other")}
    for name, want in {**data, "single": [single]}.items():
        assert [v for n, _, v in rows if n == name] == want
    for name, at, _ in rows:  # ordinals are bytes
        assert text[name].encode()[at - 1 if at else 0:][:1] in (b"[", b",", b"{") or name == "single"


def test_repair_leaves_strings_alone(spark, workdir):
    with open(f"{workdir}/a.json", "w") as f:
        f.write('[{"url":"1","issue":"x][y","solution":"] ["}][{"url":"2","issue":"z","solution":","}]')
    feed = FD.read_json_array(spark, f"{workdir}/a.json", repair=True)
    assert sorted((r.url, r.issue, r.solution) for r in feed.records.collect()) == [("1", "x][y", "] ["), ("2", "z", ",")]
    assert [r.reason for r in FD.read_json_array(spark, f"{workdir}/a.json").rejects.collect()] == ["malformed_file"]


def test_bad_elements_are_rejects_of_their_own(spark, workdir):
    with open(f"{workdir}/a.json", "w") as f:
        f.write('[{"url":"1"}, {"url":}, , {"url":"2"},]')
    feed = FD.read_json_array(spark, f"{workdir}/a.json")
    assert sorted(r.url for r in feed.records.collect()) == ["1", "2"]
    assert [r.reason for r in feed.rejects.orderBy("ordinal").collect()] == ["malformed"] * 3


def test_escaped_quotes():
    for text in (rb'"a\"b"', rb'"\\"', rb'"\\\"" "', rb'""', rb'\"'):
        want, inside, skip = [], False, False
        for c in text:
            want.append(c == 34 and not skip)
            skip = c == 92 and not skip
        assert JS.quotes(np.frombuffer(text, np.uint8)).tolist() == want


def test_array_files_of_all_partitions(spark, workdir, monkeypatch):
    """The registered scans write an array file in each task, not all rows in one."""
    from pyspark.sql import functions as F

    from quarry.operators import store as S
    from quarry.plans import files_catalog as FC
    rows = spark.range(0, 300, 1, 4).where("id < 200").select(F.concat(F.lit("u"), "id").alias("url"), F.lit("x][y").alias("issue"), F.lit("s").alias("solution"), F.lit("p").alias("product"),
                                                              F.lit("en").alias("category"), F.col("id").cast("int").alias("depth"), F.col("id").alias("ordinal"))
    S.export_json_array(rows, f"{workdir}/a", one_file=False)
    feed = FD.read_json_array(spark, f"{workdir}/a")
    assert feed.records.count() == 200 and feed.rejects.isEmpty()
    monkeypatch.setattr(FC, "items", lambda spark, sf: rows)
    written = []
    monkeypatch.setattr(FC, "scratch", lambda spark, label: written.append(f"{workdir}/{label}{len(written)}") or written[-1])
    assert FC.scan_json_array(spark, "").count() == 200
    assert FC.scan_auto_json(spark, "").where("source_index = 0").count() == 200
    for path in written[:2]:
        assert spark.read.text(path).select("_metadata.file_path").distinct().count() == 4


def test_a_split_is_looked_at_some_bytes_at_a_time(monkeypatch):
    import pyarrow as pa
    text = json.dumps(objects(random.Random(5), 50)).encode()
    rows = text.split(b"}")
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(rows)), pa.array([0] * len(rows)), pa.array(rows)], ["file", "split", "value"])
    monkeypatch.setattr(JS, "RUN_BYTES", 100, raising=False)
    runs = list(JS._runs(batch))
    assert len(runs) > 10 and b"".join(JS._bytes(batch.column("value").slice(a, b - a)).tobytes() for _, _, a, b in runs) == text + b"}"
    cutter, found = JS.Cutter(0, 0, 0), []
    for _, _, a, b in runs:
        found += cutter.feed(JS._bytes(batch.column("value").slice(a, b - a)))
    assert [json.loads(x[4]) for x in found] == objects(random.Random(5), 50)
