import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnmill.functions.vectors import embed_with_model
from turnmill.operators.answers import AnswerLog
from turnmill.operators.normalize import normalize_columns, normalize_json
from turnmill.plans.enrich import EnrichConfig, EnrichModels, enrich
from turnmill.plans.stages import StageStore, content_fingerprint, source_fingerprint
from turnmill.sources import readers, sinks
from turnmill.streaming.refresh import deduplicate_batch, incremental_refresh
from turnmill.streaming import store as stores
from turnmill.streaming.store import RepresentativeStore
from tests.test_similarity import texts


def test_jsonl_ordinals_over_many_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        want = []
        for part in range(2):
            lines = []
            for i in range(60):
                lines += ["", "  "] if i % 7 == 0 else []
                lines += ['{"broken": '] if i % 5 == 0 else []
                lines += ['{"text": 1} tail'] if i % 11 == 0 else []
                row = {"text": f"{part}-{i}"}
                want.append(row["text"])
                lines.append(json.dumps(row))
            (tmp_path / f"{part}.jsonl").write_text("\r\n".join(lines))
        df = readers.read_records(spark, str(tmp_path / "*.jsonl"))
        assert df.rdd.getNumPartitions() > 3
        got = {r["_ordinal"]: json.loads(r["raw"])["text"] for r in df.collect()}
        assert got == dict(enumerate(want))
        assert readers.malformed_jsonl(spark, str(tmp_path / "*.jsonl")).count() == 2 * (12 + 6)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\n  two \n \nthree")
    (tmp_path / "b.md").write_text("\nfour\n")
    rows = readers.read_records(spark, str(tmp_path / "a.txt")).orderBy("_ordinal").collect()
    assert [(r["_ordinal"], r["_line"], r["text"]) for r in rows] == [(0, 1, "one"), (1, 3, "two"), (2, 5, "three")]
    both = readers.read_text_lines(spark, str(tmp_path / "*")).orderBy("_ordinal").collect()
    assert [(r["_ordinal"], r["_line"]) for r in both] == [(0, 1), (1, 3), (2, 5), (3, 2)]


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "x", "n": 1.0}, {"prompt": "p", "completion": True}], indent=1))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text('[{"text": "y"}]')
    rows = normalize_json(readers.read_records(spark, str(tmp_path / "*.json"))).orderBy("_ordinal").collect()
    assert [(r["id"], r["shape"]) for r in rows] == [("0", "text"), ("1", "prompt"), ("2", "text")]
    (tmp_path / "bad.json").write_text('{"text": "x"}')
    with pytest.raises(Exception, match="expected a JSON array"):
        readers.read_records(spark, str(tmp_path / "bad.json")).collect()


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('question,answer,id\n"a ""q"", one\ntwo",yes,\nq2,,7\n')
    rows = normalize_columns(readers.read_records(spark, str(tmp_path / "a.csv"))).orderBy("_ordinal").collect()
    assert [(r["id"], [m["content"] for m in r["messages"]]) for r in rows] == [
        ("0", ['a "q", one\ntwo', "yes"]), ("7", ["q2", ""])
    ]


def test_eval_sets_and_errors(spark, tmp_path):
    inline = readers.load_eval_set(spark, [{"q": i} for i in range(201)])
    assert [json.loads(r["raw"])["q"] for r in inline.orderBy("_ordinal").collect()] == list(range(201))
    for bad in ("x.parquet", "hub:name"):
        with pytest.raises(ValueError):
            readers.load_eval_set(spark, bad)
    with pytest.raises(ValueError, match="no reader for"):
        readers.read_records(spark, "x.xml")


def test_sinks(spark, ws):
    df = spark.createDataFrame([(1, None), (2, "b")], "id long, text string")
    path = ws.path("out.jsonl")
    sinks.write_jsonl(df, path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ['{"id":1,"text":null}', '{"id":2,"text":"b"}']
    routed = ws.path("routed")
    sinks.write_routed(sinks.route(df, F.col("text") == "b"), routed)
    assert spark.read.parquet(f"{routed}/route=rejected").count() == 1


def test_stage_store_follows_input_and_parameters(spark, ws, tmp_path):
    data = str(tmp_path / "in")
    spark.range(10).write.parquet(data)
    first = source_fingerprint(spark.read.parquet(data))
    assert source_fingerprint(spark.read.parquet(data)) == first

    def run(mark, limit, force=False):
        store = StageStore(spark, str(tmp_path / "stages"), force)
        table, out = store.run("s", mark, {"limit": limit}, lambda: spark.read.parquet(data).filter(F.col("id") < limit))
        return table.count(), store.ran, out

    assert run(first, 5)[:2] == (5, ["s"]) and run(first, 5)[:2] == (5, [])
    assert run(first, 5, force=True)[:2] == (5, ["s"]) and run(first, 6)[:2] == (6, ["s"])
    spark.range(3).write.mode("append").parquet(data)
    changed = source_fingerprint(spark.read.parquet(data))
    assert changed != first and run(changed, 5)[:2] == (8, ["s"])


def test_the_report_needs_no_scan_beyond_the_writes(spark, ws, tmp_path):
    rows = [(str(i), i, [("user", f"{t} padded to a sensible length for the gate, {i}")]) for i, t in enumerate(texts(30))]
    df = spark.createDataFrame(rows, "id string, ord long, messages array<struct<role:string,content:string>>")
    answers = spark.createDataFrame([(str(i), f'{{"overall": {i % 7}}}') for i in range(30)], "id string, response string")
    said = spark.createDataFrame([(str(i), "one\ntwo") for i in range(30)], "id string, response string")
    config, marks = EnrichConfig(augment=True), {"conversations": "c", "scores": "s", "variants": "v"}
    context, found = spark.sparkContext, []
    for stages in (None, StageStore(spark, str(tmp_path / "s")), StageStore(spark, str(tmp_path / "s"))):
        out = enrich(df, answers, ws, config, said, stages=stages, sources=marks if stages else None)
        context.setJobGroup(f"report{len(found)}", "the report alone")
        found.append({(r["stage"], r["metric"]): r["value"] for r in out.report.collect()})
        assert len(context.statusTracker().getJobIdsForGroup(f"report{len(found) - 1}")) <= 1
        context.setJobGroup("other", "")
        n = out.rows.count()
        assert found[-1]["final", "rows"] == n
    assert found[0] == found[1] == found[2]
    got = found[0]
    assert got["gate", "total"] == 30 == got["dedup", "total"] and got["quality", "total"] == got["dedup", "kept"]
    assert got["quality", "kept"] + got["quality", "rejected"] == got["quality", "total"] == sum(got["quality", f"score_{i}"] for i in range(1, 6))
    none = enrich(df.limit(0), answers, ws, config, said).report.collect()
    assert {(r["stage"], r["metric"]): r["value"] for r in none}["final", "rows"] == 0


def test_specs_are_found_once_under_their_resolved_path(spark):
    listing = [("conf/global-a.yml",), ("conf/x/../global-a.yml",), ("conf//./client-me-1.yml",), ("conf/EXAMPLE.yml",), ("conf/global-b.txt",)]
    given = ["z.yml", "conf/y/../client-me-1.yml", "../up.yml", "/a/../../b.yml"]
    got = readers.discover_specs(spark.createDataFrame(listing, "path string"), "me", given).collect()
    assert {(r["path"], r["priority"], r["position"]) for r in got} == {
        ("z.yml", 0, 0), ("conf/client-me-1.yml", 0, 1), ("../up.yml", 0, 2), ("/b.yml", 0, 3), ("conf/global-a.yml", 1, None)
    }


def test_content_fingerprints_see_rows_not_files(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else f"t{i % 7}", [i, None], {"a": i}) for i in range(50)]
    schema = "id long, text string, parts array<int>, more map<string,int>"
    df = spark.createDataFrame(rows, schema)
    mark = content_fingerprint(df)
    df.repartition(7).write.parquet(str(tmp_path / "a"))
    assert content_fingerprint(spark.read.parquet(str(tmp_path / "a"))) == mark
    others = [rows[:-1], rows + rows[:1], [(0, "t0", [0, None], {"a": 0}), *rows[1:]], [(0, None, [0, 0], {"a": 0}), *rows[1:]]]
    others += [[(0, None, [0, None], {"a": 9}), *rows[1:]], rows + rows, []]
    assert len({content_fingerprint(spark.createDataFrame(r, schema)) for r in others} | {mark}) == 8
    assert content_fingerprint(df.withColumnRenamed("text", "words")) != mark


def test_a_resumed_run_calls_no_model(spark, ws, tmp_path):
    calls = tmp_path / "calls"

    def noted(answer):
        def fn(value):
            with open(calls, "a") as f:
                f.write("x")
            if "fails" in value:
                raise ValueError("no answer")
            return answer if answer else value.upper()

        return fn

    docs = [f"{t} padded to a sensible length for the gate, {i}" for i, t in enumerate(texts(12))] + ["one that fails, long enough for the gate to pass"]
    df = spark.createDataFrame([(str(i), i, [("user", d)]) for i, d in enumerate(docs)], "id string, ord long, messages array<struct<role:string,content:string>>")
    models = EnrichModels(redact=noted(None), paraphrase=noted("1. other words"), version="m1")
    config = EnrichConfig(quality_filter=False, augment=True, eval_ratio=0.2)
    found = []
    for version in ("m1", "m1", "m2"):
        models = EnrichModels(models.embed, models.review, models.redact, models.paraphrase, version=version)
        store = StageStore(spark, str(tmp_path / "stages"))
        out = enrich(df, None, ws, config, stages=store, sources={"conversations": "c"}, models=models)
        found.append((sorted(map(str, out.rows.collect())), [r["id"] for r in out.quarantined.collect()], store.ran, calls.stat().st_size))
    assert found[0][:2] == found[1][:2] == found[2][:2] and found[0][1] == ["12"]
    assert found[1][2] == [] and found[1][3] == found[0][3] < found[2][3]
    assert found[2][2] == ["redact", "split", "augment"]
    with pytest.raises(ValueError, match="version"):
        enrich(df, None, ws, config, stages=store, sources={"conversations": "c"}, models=EnrichModels(redact=noted(None)))


def test_an_answer_log_sends_each_prompt_once(spark, ws, tmp_path):
    calls = tmp_path / "calls"

    def model(value):
        with open(calls, "a") as f:
            f.write(value + "\n")
        if value == "p77" and not (tmp_path / "mended").exists():
            raise SystemExit("cut")
        if value == "p5":
            raise ValueError("never")
        return value.upper()

    def sent():
        return calls.read_text().split() if calls.exists() else []

    df = spark.createDataFrame([(i, f"p{i % 100}") for i in range(300)], "id long, prompt_text string")
    log = AnswerLog(spark, str(tmp_path / "log"), "m1")
    options = {"rows_per_slice": 10, "retries": 0, "batch_size": 4}
    with pytest.raises(Exception, match="cut|SystemExit|crashed|exited"):
        log.ask(df, model, "prompt_text", ws, **options)
    kept = {r["response"].lower() for r in log.answers().collect()}
    before = len(sent())
    (tmp_path / "mended").touch()
    rows = log.ask(df, model, "prompt_text", ws, **options).collect()
    assert len(rows) == 300 and {r["error"] for r in rows if r["id"] % 100 == 5} == {"never"}
    assert all(r["response"] == f"P{r['id'] % 100}" for r in rows if r["id"] % 100 != 5)
    # What the cut run had written is not sent again.
    assert kept.isdisjoint(sent()[before:]) and len(sent()[before:]) == 100 - len(kept)
    before = len(sent())
    assert len(log.ask(df, model, "prompt_text", ws, **options).collect()) == 300 and sent()[before:] == ["p5"]
    assert len(AnswerLog(spark, str(tmp_path / "log"), "m2").answers().collect()) == 0
    with pytest.raises(ValueError, match="version"):
        AnswerLog(spark, str(tmp_path / "log"), "")


def test_enrich_reuses_stages(spark, ws, tmp_path):
    rows = [(str(i), i, [("user", f"{t} padded to a sensible length for the gate, {i}")]) for i, t in enumerate(texts(40))]
    df = spark.createDataFrame(rows, "id string, ord long, messages array<struct<role:string,content:string>>")
    answers = spark.createDataFrame([("0", '{"overall": 1}')], "id string, response string")
    store = StageStore(spark, str(tmp_path / "s"))
    marks = {"conversations": "c1", "scores": "s1"}
    first = enrich(df, answers, ws, stages=store, sources=marks)
    one = first.rows.select("id", "split").collect()
    again = StageStore(spark, str(tmp_path / "s"))
    two = enrich(df, answers, ws, stages=again, sources=marks).rows.select("id", "split").collect()
    assert store.ran == ["gate", "dedup", "quality", "split"] and again.ran == [] and sorted(one) == sorted(two)
    assert "0" not in {r["id"] for r in one} and [r["id"] for r in first.rejects.collect()] == ["0"]
    n_kept, n_gone = len(one), first.duplicates.count()
    assert n_kept + n_gone + 1 == 40 and {r["ord"] for r in first.duplicates.collect()}.isdisjoint(int(r["id"]) for r in one)

    # Each input changing alone reruns what reads it, and only that.
    def ran(**changes):
        fresh = StageStore(spark, str(tmp_path / "s"))
        given = {"scores": answers, "variants": None, "config": EnrichConfig()} | changes
        out = enrich(df, given["scores"], ws, given["config"], given["variants"], stages=fresh, sources=marks | changes.get("sources", {}))
        return fresh.ran, out.rows.count()

    worse = spark.createDataFrame([(str(i), '{"overall": 1}') for i in range(40)], "id string, response string")
    assert ran(scores=worse, sources={"scores": "s2"}) == (["quality", "split"], 0)
    assert ran(sources={"conversations": "c2"})[0] == ["gate", "dedup", "quality", "split"]
    said = spark.createDataFrame([("1", "another"), ("2", "other")], "id string, response string")
    augmented = EnrichConfig(augment=True)
    more = ran(config=augmented, variants=said, sources={"variants": "v1"})
    assert more[0] == ["augment"] and ran(config=augmented, variants=said, sources={"variants": "v1"})[0] == []
    assert ran(config=augmented, variants=said, sources={"variants": "v2"})[0] == ["augment"]
    assert ran(config=EnrichConfig(redact=False))[0] == ["split"]
    with pytest.raises(ValueError, match="fingerprint"):
        enrich(df, answers, ws, stages=again, sources={"conversations": "c1"})
    with pytest.raises(ValueError, match="not unique"):
        enrich(df.unionByName(df), answers, ws)
    off = enrich(df, answers, ws, EnrichConfig(dedup=False, quality_filter=False, redact=False))
    assert off.rows.count() == 40


def test_refresh_keeps_what_one_run_keeps(spark, ws, tmp_path):
    docs = [f"{t} padded to a sensible length for the gate" for t in texts(90, seed=4)]
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")

    # A third without id, a third with text ids, a third with one and the same id.
    names = [(None, f"d{i}", "7")[i % 3] for i in range(90)]

    def drop(lo, hi):
        part = spark.createDataFrame([(names[i], docs[i], i) for i in range(lo, hi)], "id string, text string, at long")
        part.write.mode("append").parquet(inbox)

    def refresh():
        stream = spark.readStream.schema("id string, text string, at long").parquet(inbox)
        incremental_refresh(
            stream, str(tmp_path / "store"), out, str(tmp_path / "progress"), order="at", keep=["at"]
        ).awaitTermination()
        return {r["at"]: (r["id"], r["text"]) for r in spark.read.parquet(out).collect()}

    drop(0, 30)
    refresh()
    drop(30, 60)
    refresh()
    drop(60, 90)
    got = refresh()
    turn = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([(str(i), i, [("user", d)]) for i, d in enumerate(docs)], f"id string, ord long, messages {turn}")
    whole = enrich(df, None, ws, EnrichConfig(quality_filter=False)).rows.collect()
    assert {at: text for at, (_, text) in got.items()} == {r["ord"]: r["text"] for r in whole}
    assert all(name == (f"{min(at // 30, 2)}-{at}", f"d{at}", "7")[at % 3] for at, (name, _) in got.items())


def test_a_replay_with_other_splits_names_records_alike(spark, tmp_path):
    docs = [f"{t} padded to a sensible length for the gate" for t in texts(400, seed=9)]
    inbox = str(tmp_path / "in")
    spark.createDataFrame([(d,) for d in docs], "text string").coalesce(2).write.text(inbox)
    found = []
    for run, size in enumerate(("128m", "4k", "1k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1" if run else "4m")
        stream = spark.readStream.text(inbox).select(F.lit(None).cast("string").alias("id"), F.col("value").alias("text"), "_metadata")
        out = str(tmp_path / f"out{run}")
        incremental_refresh(stream, str(tmp_path / f"store{run}"), out, str(tmp_path / f"progress{run}")).awaitTermination()
        found.append(sorted((r["id"], r["text"]) for r in spark.read.parquet(out).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found[0]) > 100 and found[0] == found[1] == found[2]


def test_a_batch_opens_only_what_its_grams_touch(spark, ws, tmp_path):
    def batch(i, words):
        rng = random.Random(i)
        return [(1000 * i + k, " ".join(rng.choice(words) for _ in range(12))) for k in range(40)]

    own = [[f"w{i}x{k}" for k in range(30)] for i in range(12)]
    store = RepresentativeStore(spark, str(tmp_path / "store"), buckets=64)
    opened, kept = [], set()
    for i in range(12):
        rows = batch(i, own[i])
        if i in (2, 11):
            # Batches that also repeat texts of the first one.
            rows += [(1000 * i + 500 + k, text) for k, (_, text) in enumerate(batch(0, own[0])[:5])]
        store.opened.clear()
        df = spark.createDataFrame(rows, "ord long, text string")
        kept |= {r["ord"] for r in deduplicate_batch(df, i, store, ws).collect()}
        opened.append(sum(f"batch={b}/" in p for p in store.opened for b in range(i)))
    everything = [r for i in range(12) for r in batch(i, own[i])]
    assert kept == {o for o, _ in everything}
    # Foreign batches open next to nothing however many are stored; the last one opens what the third one did.
    assert opened[0] == 0 and max(opened[3:11]) <= 12
    assert 0 < opened[2] and opened[11] <= opened[2] + 12


def test_filters_hold_their_grams(spark, ws, tmp_path):
    """Bitmaps made by batches are those of the aggregate over all probes."""
    rng = np.random.default_rng(3)
    rows = [(int(g) >> 48 & 3, int(g)) for g in rng.integers(-(2**63), 2**63 - 1, 20_000)]
    entries = ws.table(spark.createDataFrame(rows, "bucket int, gram long").repartition(3), "e")
    store = RepresentativeStore(spark, str(tmp_path / "s"), buckets=4)
    n = 40_000
    segments = n * stores.GRAM_BITS // (4 * 32_768) + 1
    gram = F.col("gram")
    segment = F.pmod(F.shiftrightunsigned(gram, 40).bitwiseAND((1 << 24) - 1), F.lit(segments)).cast("int")
    probes = F.array(*[F.shiftrightunsigned(gram, s).bitwiseAND(32_767) for s in stores.SHIFTS])
    want = entries.select("bucket", segment.alias("segment"), F.explode(probes).alias("bit")).groupBy("bucket", "segment")
    want = want.agg(F.bitmap_construct_agg("bit").alias("bits")).select("bucket", "segment", F.lit(segments).alias("segments"), "bits")
    got = store._filters(entries, n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    batches = [b for b in entries.filter("bucket = 0").select("bucket", "gram").toArrow().to_batches()]
    cut = [r for b in stores._bitmaps(segments, most=1)(batches) for r in b.to_pylist()]
    assert len(cut) > segments // 2 and {r["bucket"] for r in cut} == {0}


def test_filters_are_tested_with_their_own_grams(monkeypatch):
    """A batch's bucket is done with the first hit, and a segment meets only the grams that may be in it."""
    rng = np.random.default_rng(5)
    grams = rng.integers(-(2**63), 2**63 - 1, 4_000)
    segments = 40
    rows = [(0, int(g), None, None, None, None) for g in grams]
    full, empty = b"\xff" * 4096, b"\x00" * 4096
    rows += [(0, None, batch, s, segments, full if batch != 1 else empty) for batch in range(3) for s in range(segments)]
    kinds = [("bucket", pa.int32()), ("gram", pa.int64()), ("batch", pa.int64()), ("segment", pa.int32()), ("segments", pa.int32()), ("bits", pa.binary())]
    whole = pa.RecordBatch.from_pydict({k: pa.array(c, t) for (k, t), c in zip(kinds, zip(*rows))})
    tested = []
    plain = stores._probes
    monkeypatch.setattr(stores, "_probes", lambda near: (tested.append(len(near)), plain(near))[1])
    got = [(b, k) for out in stores._matches(iter([whole.slice(i, 1_000) for i in range(0, len(rows), 1_000)])) for b, k in zip(*out.to_pydict().values())]
    assert got == [(0, 0), (2, 0)]
    assert len(tested) <= segments + 2 and sum(tested) < 2 * len(grams)


def test_whole_run_with_models(spark, ws):
    rows = [(str(i), i, [("user", f"{t} padded to a sensible length for the gate")]) for i, t in enumerate(texts(30, seed=6))]
    df = spark.createDataFrame(rows, "id string, ord long, messages array<struct<role:string,content:string>>")

    def embed():
        import zlib

        import numpy as np

        return lambda inputs: np.stack([np.random.default_rng(zlib.crc32(x.split()[-1].encode()[:1])).normal(size=8) + len(x) % 2 for x in inputs])

    def review(asked):
        return '{"overall": 1}' if "on law" not in asked else '{"overall": 4}'

    def hide(text):
        if "gate" not in text:
            raise ValueError("no answer")
        return text.replace("gate", "[GATE]")

    models = EnrichModels(embed=embed, review=review, redact=hide, paraphrase=lambda t: f"1. {t}\n- other", domain="law")
    out = enrich(df, None, ws, EnrichConfig(augment=True, dedup_threshold=0.999), models=models)
    kept = out.rows.collect()
    assert out.rejects.count() == 0 and out.quarantined.count() == 0
    originals = [r for r in kept if r["_aug_source"] is None]
    assert len(originals) + out.duplicates.count() == 30
    assert len(kept) == len(originals) + 2 * sum(r["split"] == "train" for r in originals)
    assert all("[GATE]" in r["text"] for r in originals)
    with pytest.raises(ValueError, match="scores or a review"):
        enrich(df, None, ws)


def test_user_model_embeddings(spark):
    def make():
        import numpy as np

        return lambda inputs: np.stack([[len(x), 0.0] for x in inputs]).astype("float32")

    df = spark.createDataFrame([("a",), ("bb",)], "t string")
    got = [list(r[0]) for r in df.select(embed_with_model(F.col("t"), make)).collect()]
    assert got == [[1.0, 0.0], [1.0, 0.0]]
