"""JSON arrays and quoted CSV in many blocks against the readers that take a file at a time."""

import csv
import json
import random

import pytest

from turnmill.sources.readers import read_csv, read_json_array
from turnmill.sources.split import _pieces, read_csv_split, read_json_array_split


@pytest.fixture(params=["331", "128m"])
def blocks(spark, request):
    """Blocks from far shorter than a record to longer than a file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choice('ab,[]{}":\\\n\té日') for _ in range(rng.randrange(12)))
    if kind == 3:
        return rng.choice([None, True, 1.5, -3, 10**12])
    if kind < 6:
        return {f"k{i},": value(rng, depth + 1) for i in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


def test_json_arrays(spark, ws, tmp_path, blocks):
    rng = random.Random(1)
    for i, indent in enumerate((None, 2, None, None)):
        items = [{"n": j, "v": value(rng)} for j in range(30)] if i < 2 else [] if i == 2 else ["one, only", 'q"', [1, [2, 3]], 7, {}]
        (tmp_path / f"f{i}.json").write_text(f"  {json.dumps(items, indent=indent, ensure_ascii=i == 0)}\n")
    path = str(tmp_path)
    got = [(r["_ordinal"], r["raw"]) for r in read_json_array_split(spark, path, ws).orderBy("_ordinal").collect()]
    assert got == [(r["_ordinal"], r["raw"]) for r in read_json_array(spark, path).orderBy("_ordinal").collect()] and len(got) == 65
    if blocks == "331":
        assert _pieces(spark, path, ",").rdd.getNumPartitions() > 8


@pytest.mark.parametrize("text", ['{"a": 1}', "[1, 2", '[1, "x]', "[1], 2", "[1, ]", "x"])
def test_anything_but_an_array_is_an_error(spark, ws, tmp_path, text):
    (tmp_path / "f.json").write_text(text)
    with pytest.raises(Exception, match="expected a JSON array"):
        read_json_array_split(spark, str(tmp_path), ws).collect()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv(spark, ws, tmp_path, blocks, end):
    rng = random.Random(2)
    for i in range(3):
        with open(tmp_path / f"f{i}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", "the text", "rest"])
            for j in range(40):
                cell = "".join(rng.choice('ab,"\n é日\\') for _ in range(rng.randrange(30)))
                out.writerow([j, "x" + cell.replace("\\", "/") + "y", rng.choice(["", "z", "two\nlines"])])
                if j % 20 == 0:
                    f.write(end)
    path = str(tmp_path)
    columns = ["_ordinal", "id", "the text", "rest"]
    got = sorted(tuple(r[c] for c in columns) for r in read_csv_split(spark, path, ws).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert got == sorted(tuple(r[c] for c in columns) for r in read_csv(spark, path).collect()) and len(got) == 120
