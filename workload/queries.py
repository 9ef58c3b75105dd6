"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.functions import chat, pii
from turnmill.functions.parsing import clean_variants, parse_scores, parse_verdict
from turnmill.functions.template import compile_template
from turnmill.functions.vectors import l2_normalize, squared_norm, word_grams
from turnmill.operators import (
    augment, balls, banded, dedup, judge, normalize, packing, perf, quality, sampling, scoring, semantic, sketches,
)
from turnmill.operators.leaders import leader_clusters, with_cluster_ids
from turnmill.operators.model_apply import apply_model, redact_with_model
from turnmill.operators.similarity import DenseIndex, cosine_pairs as dense_pairs
from turnmill.plans.enrich import EnrichConfig, EnrichModels, enrich
from turnmill.plans.stages import StageStore, source_fingerprint
from turnmill.sources import readers, sinks, split
from turnmill.streaming.refresh import incremental_refresh as start_refresh
from turnmill.workspace import Workspace

DENSE_THRESHOLD = 0.3


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark, sf) -> DataFrame:
    """Documents over enough tasks for work that is heavy per row."""
    return readers.spread(_t(spark, sf, "documents"))


def _conversations(spark, sf) -> DataFrame:
    return normalize.fold_turns(_t(spark, sf, "conversations"))


def _half(c, second: bool):
    cut = F.ceil(F.length(c) / 2).cast("int")
    return F.substring(c, cut + 1, F.length(c)) if second else F.left(c, cut)


def _raw_records(spark, sf) -> DataFrame:
    """Documents as raw JSON in eight layouts, with and without ids."""
    d = _documents(spark, sf)
    a, b = _half(F.col("text"), False), _half(F.col("text"), True)
    lit = F.lit

    def obj(**fields):
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    def turn(role, content):
        return F.struct(lit(role).alias("role"), content.alias("content"))

    kind = F.col("doc_id") % 8
    raw = (
        F.when(kind == 0, obj(id=F.col("doc_id"), messages=F.array(turn("user", a), turn("assistant", b))))
        .when(kind == 1, obj(id=lit(""), doc_id=F.concat(lit("d"), F.col("doc_id")), prompt=a, completion=b))
        .when(kind == 2, obj(instruction=F.col("lang"), input=a, output=b))
        .when(kind == 3, obj(id=F.col("source"), question=a, answer=F.col("n_chars")))
        .when(kind == 4, obj(Context=a, Response=b, text=F.col("text")))
        .when(kind == 5, obj(doc_id=F.col("doc_id"), text=F.col("text")))
        .when(kind == 6, obj(title=a, body=b))
        .otherwise(
            obj(
                id=F.col("doc_id"),
                messages=F.array(F.struct(a.alias("content"))),
                prompt=a,
                completion=F.col("n_chars") > 1000,
            )
        )
    )
    return d.select("doc_id", raw.alias("raw"), F.col("doc_id").alias("_ordinal"))


def _normalized(spark, sf) -> DataFrame:
    return normalize.normalize_json(_raw_records(spark, sf), keep=["doc_id", "_ordinal"])


def _documents_gated(spark, sf) -> DataFrame:
    d = _documents(spark, sf).select("doc_id", "text", F.col("doc_id").alias("_ordinal"))
    return normalize.length_gate(normalize.normalize_columns(d, keep=["doc_id", "text"]))


# --- sources and sinks ------------------------------------------------------------


def scan_jsonl(spark, sf):
    """Documents written as JSON lines with blank and broken lines, read back."""
    path = Workspace(spark).path("docs.jsonl")
    good = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    line = F.when(F.col("doc_id") % 7 == 5, F.lit('{"id": 1, "text": ')).otherwise(good)
    lines = F.when(F.col("doc_id") % 10 == 3, F.array(F.lit("  "), line)).otherwise(F.array(line))
    docs = _t(spark, sf, "documents").orderBy("doc_id")
    docs.select(F.explode(lines)).write.text(path)
    rows = normalize.normalize_json(readers.read_jsonl(spark, path))
    n = chat.total_chars(F.col("messages"))
    return rows.select(F.col("_ordinal").alias("ordinal"), "id", n.alias("n_chars"))


def scan_json_array(spark, sf):
    """Documents written as JSON array files of at most 500 elements, read back."""
    path = Workspace(spark).path("docs.json")
    one = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    batch = F.floor(F.col("doc_id") / 500)
    arrays = _t(spark, sf, "documents").groupBy(batch.alias("b")).agg(F.collect_list(one).alias("a"))
    text = F.concat(F.lit("["), F.array_join("a", ",\n"), F.lit("]"))
    arrays.select(text).write.option("maxRecordsPerFile", 1).text(path)
    rows = normalize.normalize_json(readers.read_json_array(spark, path))
    return rows.select("id", chat.row_text(F.col("messages")).alias("text"))


def scan_csv(spark, sf):
    """Documents written as quoted CSV with newlines inside cells, read back."""
    path = Workspace(spark).path("docs.csv")
    docs = _t(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.csv(
        path, header=True, quoteAll=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    rows = readers.read_csv(spark, path)
    rows = normalize.normalize_columns(rows, keep=["lang"])
    return rows.select("id", "lang", chat.row_text(F.col("messages")).alias("text"))


def scan_json_array_split(spark, sf):
    """Documents written as JSON arrays, each read by several tasks."""
    path = Workspace(spark).path("docs.json")
    docs = _t(spark, sf, "documents")
    block = F.floor(F.col("doc_id") / 5_000)
    arrays = docs.groupBy(block).agg(F.to_json(F.collect_list(F.struct("doc_id", "text"))).alias("value"))
    arrays.repartition(arrays.columns[0]).select("value").write.option("maxRecordsPerFile", 1).text(path)
    rows = normalize.normalize_json(split.read_json_array_split(spark, path, Workspace(spark)))
    return rows.select("id", chat.row_text(F.col("messages")).alias("text"))


def scan_csv_split(spark, sf):
    """Documents written as quoted CSV with newlines inside cells, each file read by several tasks."""
    path = Workspace(spark).path("docs.csv")
    _t(spark, sf, "documents").select("doc_id", "text", "lang").write.csv(
        path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    rows = normalize.normalize_columns(split.read_csv_split(spark, path, Workspace(spark)), keep=["lang"])
    return rows.select("id", "lang", chat.row_text(F.col("messages")).alias("text"))


def scan_text_lines(spark, sf):
    return readers.explode_lines(_t(spark, sf, "documents"), "doc_id", "text")


def scan_text_file(spark, sf):
    """Documents written line by line to text files, read back with ordinals."""
    path = Workspace(spark).path("docs.txt")
    _t(spark, sf, "documents").orderBy("doc_id").select("text").write.text(path)
    rows = readers.read_text_lines(spark, path)
    return rows.select(F.col("_ordinal").alias("ordinal"), "text")


def load_eval_set(spark, sf):
    path = Workspace(spark).path("items") + "/items.jsonl"
    items = _t(spark, sf, "benchmark").orderBy("item_id")
    items.select(F.to_json(F.struct("item_id", "text"))).write.text(path)
    rows = readers.load_eval_set(spark, path)
    return rows.select(
        F.get_json_object("raw", "$.item_id").cast("long").alias("item_id"),
        F.get_json_object("raw", "$.text").alias("text"),
    )


def _spec_listing(spark, sf):
    kind = F.col("page_id") % 6
    name = (
        F.when(kind == 0, F.lit("global-"))
        .when(kind == 1, F.lit("client-acme-"))
        .when(kind == 2, F.lit("client-other-"))
        .when(kind == 3, F.lit("example-global-"))
        .when(kind == 4, F.lit("./global-"))
        .otherwise(F.lit("notes-"))
    )
    number = F.floor(F.col("page_id") / 12).cast("string")
    return _t(spark, sf, "pages").select(
        F.concat(F.lit("configs/extra/"), name, number, F.lit(".yml")).alias("path")
    )


def discover_specs(spark, sf):
    found = readers.discover_specs(_spec_listing(spark, sf), "acme", ["configs/extra/global-1.yml"])
    return found.select("path", "priority")


def detect_format(spark, sf):
    """Pages as files with suffixes in either case, some without a reader."""
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".jsonl", ".JSON", ".csv", ".Txt", ".md", ".xml", "")]), (F.col("page_id") % 7 + 1).cast("int"))
    path = F.concat(F.lit("in.d/page-"), F.col("page_id").cast("string"), suffix)
    return _t(spark, sf, "pages").select("page_id", readers.format_of(path).alias("format"))


def write_jsonl(spark, sf):
    """Documents written as JSON lines with null fields, read back as plain lines."""
    path = Workspace(spark).path("lines")
    lang = F.when(F.col("lang") != "en", F.col("lang"))
    sinks.write_jsonl(_t(spark, sf, "documents").select("doc_id", lang.alias("lang"), "n_chars"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def rubric_prompt(spark, sf):
    """What a reviewer of each conversation is asked, with a domain."""
    models = EnrichModels(rubric="Rate it.", domain="law")
    asked = F.concat(F.lit(quality.rubric_prompt(models.rubric, models.domain) + "\n\n"), chat.review_text(F.col("messages")))
    return _conversations(spark, sf).select("conv_id", F.md5(asked).alias("prompt_md5"))


def route_kept_rejected(spark, sf):
    """Scored documents written to both routes in one job, read back."""
    path = Workspace(spark).path("routed")
    scored = _scored(spark, sf).select("doc_id", "_quality")
    routed = quality.quality_filter(scored).select(
        "doc_id", F.col("_quality.overall").alias("overall"), "route"
    )
    sinks.write_routed(routed, path)
    return spark.read.schema("doc_id long, overall int, route string").parquet(path)


# --- projection and normalisation ---------------------------------------------------


def normalize_schema(spark, sf):
    rows = _normalized(spark, sf)
    return rows.select(
        "doc_id", "shape",
        F.size("messages").alias("n_turns"),
        chat.first_content(F.col("messages"), "user").alias("user_text"),
        chat.first_content(F.col("messages"), "assistant").alias("assistant_text"),
    ).withColumn("n_turns", F.when(F.col("shape").isNotNull(), F.col("n_turns")))


def resolve_id(spark, sf):
    return _normalized(spark, sf).select("doc_id", "id")


def fold_turns(spark, sf):
    c = _conversations(spark, sf)
    return c.select("conv_id", "n_turns", "n_chars", chat.review_text(F.col("messages")).alias("transcript"))


def length_gate(spark, sf):
    return _documents_gated(spark, sf).select("doc_id", "n_chars", "route")


def funnel_counts(spark, sf):
    return normalize.funnel_counts(normalize.length_gate(_normalized(spark, sf)))


def row_text(spark, sf):
    return _conversations(spark, sf).select("conv_id", chat.row_text(F.col("messages")).alias("text"))


def review_text(spark, sf):
    return _conversations(spark, sf).select("conv_id", chat.review_text(F.col("messages")).alias("text"))


def render_chat(spark, sf):
    m = F.col("messages")
    return _conversations(spark, sf).select(
        "conv_id",
        chat.render_chat(m, chat.CHATML).alias("chatml"),
        chat.render_chat(m, chat.LLAMA3).alias("llama3"),
    )


#: A published kind of template: the system turn joins the first question, answers end with a mark.
INSTRUCT = (
    "{%- if messages[0]['role'] == 'system' -%}{%- set rest = messages[1:] -%}{%- set system = messages[0]['content'] -%}"
    "{%- else -%}{%- set rest = messages -%}{%- set system = false -%}{%- endif -%}{{ bos_token }}"
    "{%- for m in rest -%}{%- if m.role == 'user' -%}"
    "{{ '[INST] ' }}{%- if loop.first and system -%}{{ '<<SYS>>' ~ system | trim ~ '<</SYS>>\n' }}{%- endif -%}{{ m.content.strip() + ' [/INST]' }}"
    "{%- else -%}{{ ' ' ~ loop.index ~ '/' ~ loop.length ~ ' ' ~ m.role | upper ~ ': ' ~ m.content ~ eos_token }}{%- endif -%}{%- endfor -%}"
)


def chat_template(spark, sf):
    render = compile_template(INSTRUCT)
    return _conversations(spark, sf).select(
        "conv_id", render(F.col("messages"), bos_token="<s>", eos_token="</s>").alias("text")
    )


def render_prompt(spark, sf):
    return _conversations(spark, sf).select(
        "conv_id", chat.render_prompt(F.col("messages"), chat.CHATML).alias("prompt")
    )


def _first_turns(spark, sf):
    roles = {"user": "prompt", "assistant": "reference"}
    return normalize.first_by_role(_t(spark, sf, "conversations"), roles).filter(F.col("prompt").isNotNull())


def first_turns(spark, sf):
    return _first_turns(spark, sf)


def render_template(spark, sf):
    template = "Review {source} ({lang}):\n{text}\nNote: {missing}{n_chars} {{doc_id}}"
    d = _t(spark, sf, "documents")
    columns = {c: F.col(c) for c in d.columns}
    return d.select("doc_id", chat.field_template(template, columns).alias("prompt"))


def tag_domain(spark, sf):
    return _t(spark, sf, "pages").select("page_id", scoring.tag_domain(F.col("url")).alias("domain"))


# --- personal data ------------------------------------------------------------------


def scrub_text(spark, sf):
    docs = _documents(spark, sf).select(F.lit("doc").alias("kind"), F.col("doc_id").alias("key"), "text")
    urls = _t(spark, sf, "pages").select(
        F.lit("url").alias("kind"), F.col("page_id").alias("key"), F.concat(F.lit("Dear Anna see "), "url").alias("text")
    )
    return docs.unionByName(urls).select("kind", "key", pii.scrub(F.col("text")).alias("text"))


def scrub_messages(spark, sf):
    scrubbed = pii.scrub_messages(F.col("messages"))
    return _conversations(spark, sf).select("conv_id", chat.row_text(scrubbed).alias("text"))


def pii_counts(spark, sf):
    d = _documents(spark, sf).select("source", *pii.pii_counts(F.col("text")))
    labels = [label.lower() for label, _ in pii.SCRUB_PATTERNS]
    return d.groupBy("source").agg(*[F.sum(c).alias(c) for c in labels])


def redact_corpus(spark, sf):
    turns = F.array(
        *[F.struct(F.lit(r).alias("role"), F.col("text").alias("content")) for r in ("system", "user")]
    )
    d = _documents(spark, sf).withColumn("messages", pii.redact_messages(turns))
    m = F.col("messages")
    return d.select(
        "doc_id",
        chat.first_content(m, "system").alias("system_text"),
        chat.first_content(m, "user").alias("user_text"),
    )


# --- dedup and similarity -----------------------------------------------------------


def embed_text(spark, sf):
    g = word_grams(_documents(spark, sf), "doc_id", "text")
    return g.select(
        "doc_id",
        F.size("grams").cast("long").alias("n_grams"),
        F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n_total"),
        "norm2",
        F.array_join(F.transform(F.array_sort("counts"), lambda x: x.cast("string")), ",").alias("counts"),
    )


def _embeddings(spark, sf):
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("ord"), F.col("embedding").alias("vec"))


def l2_norm(spark, sf):
    """Embeddings stretched by their label, brought back to unit length."""
    e = _t(spark, sf, "embeddings")
    stretched = F.transform("embedding", lambda x: (x * F.col("label")).cast("float"))
    unit = e.select("vec_id", l2_normalize(stretched).alias("v"))
    return unit.select(
        "vec_id",
        F.round(F.sqrt(squared_norm(F.col("v"))), 4).alias("length"),
        F.round(F.element_at("v", 1).cast("double"), 4).alias("first"),
        F.round(F.element_at("v", -1).cast("double"), 4).alias("last"),
    )


def cosine_pairs(spark, sf):
    pairs = dense_pairs(_embeddings(spark, sf), DENSE_THRESHOLD, Workspace(spark))
    return pairs.select(
        F.col("rep").alias("a"), F.col("ord").alias("b"), F.round("sim", 6).alias("sim")
    )


def _planted(spark, sf, ws):
    """Embeddings, and a near copy of every second one."""
    e = _embeddings(spark, sf).select((F.col("ord") * 2).alias("ord"), "vec")
    copy = F.zip_with("vec", F.reverse("vec"), lambda x, y: (x + y * 0.2).cast("float"))
    near = e.filter("ord % 4 = 0").select((F.col("ord") + 1).alias("ord"), l2_normalize(copy).alias("vec"))
    return ws.table(e.unionByName(near), "planted")


def cosine_pairs_banded(spark, sf):
    """Pairs of embeddings and planted near copies, through bands of hyperplane signs."""
    ws = Workspace(spark)
    pairs = banded.cosine_pairs_banded(_planted(spark, sf, ws), semantic.DEFAULT_THRESHOLD, ws)
    return pairs.select(F.col("rep").alias("a"), F.col("ord").alias("b"), F.round("sim", 5).alias("sim"))


def cosine_pairs_balls(spark, sf):
    """The same pairs through the index of two levels of balls, exactly."""
    ws = Workspace(spark)
    rows = _planted(spark, sf, ws)
    index = balls.BallIndex.build(rows, semantic.DEFAULT_THRESHOLD, rows.count())
    pairs = index.earlier_pairs(rows, rows, ws)
    return pairs.select(F.col("rep").alias("a"), F.col("ord").alias("b"), F.round("sim", 5).alias("sim"))


def leader_cluster_ids(spark, sf):
    ws = Workspace(spark)
    e = ws.table(_embeddings(spark, sf), "embeddings")
    index = DenseIndex.build(e, DENSE_THRESHOLD, e.count())
    assigned = ws.table(leader_clusters(e, index, ws), "assigned")
    return with_cluster_ids(assigned, ws).select(
        F.col("ord").alias("vec_id"), F.col("rep").alias("rep_id"), "cluster_id", "kept"
    )


def embedding_dedup(spark, sf):
    """Duplicates by the embeddings of a model, at the threshold for texts."""
    e = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    return semantic.embedding_dedup(e, Workspace(spark), "vec_id").select(
        "vec_id", "rep_vec_id", F.round("similarity", 6).alias("similarity"), "state", "cluster_id"
    )


def exact_dedup(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    return dedup.exact_dedup(docs, "text", "doc_id").select("doc_id", "n_copies", "text")


def _clusters(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    return semantic.semantic_dedup(docs, Workspace(spark), "doc_id")


def semantic_dedup(spark, sf):
    return _clusters(spark, sf).select(
        "doc_id", "rep_doc_id", F.round("similarity", 6).alias("similarity"), "state", "cluster_id"
    )


def dedup_stats(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    clusters = semantic.semantic_dedup(docs, Workspace(spark), "doc_id", cluster_ids=False)
    return semantic.dedup_stats(clusters, semantic.DEFAULT_THRESHOLD)


# --- scores, filters, augmentation --------------------------------------------------


def _score_responses(spark, sf):
    """A reviewer's answer per labelled document, in ten forms."""
    kind = F.col("doc_id") % 10
    score = F.when(F.col("quality") == 1, F.lit(4)).otherwise(F.lit(2)).cast("string")
    c, lit = F.concat, F.lit
    response = (
        F.when(kind == 0, c(lit('{"clarity": 5, "overall": '), score, lit(', "reason": "ok"}')))
        .when(kind == 1, c(lit('Sure! {"overall": '), score, lit(', "reason": "a {b} c"} Bye.')))
        .when(kind == 2, c(lit('  {"overall": "'), score, lit('"}\n')))
        .when(kind == 3, c(lit('{"overall": '), score, lit('.7, "domain_fit": 1}')))
        .when(kind == 4, lit('{"overall": 9}'))
        .when(kind == 5, lit('{"clarity": 2}'))
        .when(kind == 6, lit('{"overall": "high"}'))
        .when(kind == 7, c(lit('[{"overall": '), score, lit("}]")))
        .when(kind == 8, c(lit("no braces "), score))
        .otherwise(c(lit('{"overall": '), score, lit(', "extra": {"x": 1}} and } more')))
    )
    return _t(spark, sf, "labels").select("doc_id", response.alias("response"))


def parse_score_answers(spark, sf):
    parsed = parse_scores(_score_responses(spark, sf))
    q = "_quality."
    return parsed.select(
        "doc_id",
        *[F.col(q + k).alias(k) for k in ("clarity", "domain_fit", "overall", "reason", "parse_failed", "raw")],
    )


def _scored(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    return quality.attach_scores(docs, _score_responses(spark, sf), "doc_id")


def quality_filter(spark, sf):
    return quality.quality_filter(_scored(spark, sf)).select(
        "doc_id", "lang", F.col("_quality.overall").alias("overall"), "route"
    )


def score_histogram(spark, sf):
    return quality.score_histogram(_scored(spark, sf))


def _variant_responses(spark, sf):
    turns = _first_turns(spark, sf)
    text = F.regexp_replace("prompt", "[\n]", " ")
    answer = F.concat(
        F.lit("1. "), text, F.lit("\n\n 2) - Please: "), F.lower(text), F.lit("\n...\n- Or: "), text, F.lit("\n4. more")
    )
    none = F.length("prompt") % 5 == 0
    response = F.when(none, F.lit("\n 3.\n")).otherwise(answer)
    return turns.select(F.col("conv_id").cast("string").alias("id"), response.alias("response"))


def variant_lines(spark, sf):
    return _variant_responses(spark, sf).select("id", F.posexplode(clean_variants(F.col("response"), 3)).alias("j", "variant")).withColumn("j", F.col("j").cast("long"))


def augment_rows(spark, sf):
    rows = _conversations(spark, sf).select("id", "messages")
    out = augment.augment_rows(rows, _variant_responses(spark, sf))
    return out.select("id", F.col("_aug_source").alias("aug_source"), chat.row_text(F.col("messages")).alias("text"))


# --- samples, splits, packs -----------------------------------------------------------


def seeded_sample(spark, sf):
    return sampling.seeded_sample(_t(spark, sf, "documents").select("doc_id", "lang"), key="doc_id")


def train_eval_split(spark, sf):
    return sampling.train_eval_split(_t(spark, sf, "documents").select("doc_id", "source"), key="doc_id")


def split_report(spark, sf):
    return sampling.split_report(train_eval_split(spark, sf), base_model="example")


def head_rows(spark, sf):
    """First 100 usable prompts, and usable ones among the first 10 conversations."""
    c = _conversations(spark, sf)
    usable = F.exists("messages", lambda m: m["role"] == "system")
    a = sampling.head_rows(c, 100, "conv_id", usable).select(F.lit("filter_first").alias("mode"), "conv_id")
    b = sampling.head_rows(c, 10, "conv_id", usable, filter_first=False)
    return a.unionByName(b.select(F.lit("limit_first").alias("mode"), "conv_id"))


def pack_sequences(spark, sf):
    kept = _documents_gated(spark, sf).filter("route = 'kept'")
    return packing.pack_sequences(kept, Workspace(spark), "doc_id", "text")


# --- judging ----------------------------------------------------------------------


def _outputs(spark, sf):
    """Second and fourth turns as outputs of two models; very short ones failed."""
    turns = _t(spark, sf, "conversations").filter("role = 'assistant'")
    model = F.when(F.col("turn") % 4 == 1, F.lit("base")).otherwise(F.lit("finetune"))
    ranked = turns.select(
        F.col("conv_id").alias("id"), model.alias("model"), "turn",
        F.when(F.length("text") >= 60, F.concat(F.lit(" "), "text", F.lit("\n"))).alias("output"),
        F.ceil(F.length("text") / 4).cast("long").alias("tokens"),
    )
    first = ranked.groupBy("id", "model").agg(F.min("turn").alias("turn"))
    return ranked.join(first, ["id", "model", "turn"]).drop("turn")


def _prompts(spark, sf):
    return _first_turns(spark, sf).withColumnRenamed("conv_id", "id")


def pair_outputs(spark, sf):
    return judge.pair_outputs(_prompts(spark, sf), _outputs(spark, sf))


def unpaired_rows(spark, sf):
    return judge.unpaired_rows(_prompts(spark, sf), _outputs(spark, sf)).select("id", "prompt")


def _blind(spark, sf):
    docs = _t(spark, sf, "documents")
    pairs = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("prompt"),
        _half(F.col("text"), False).alias("base_output"), _half(F.col("text"), True).alias("finetune_output"),
    )
    return judge.blind_pairs(pairs)


def _verdict_responses(spark, sf):
    kind = F.col("doc_id") % 9
    lit = F.lit
    response = (
        F.when(kind == 0, lit('{"winner": "A", "reason": "clear"}'))
        .when(kind == 1, lit('I say {"winner": "b"} ok'))
        .when(kind == 2, lit('{"winner": "TIE", "reason": null}'))
        .when(kind == 3, lit('{"winner": null}'))
        .when(kind == 4, lit('So {"winner": "A", "why": {"x": 1}} done'))
        .when(kind == 5, F.concat(lit("unclear "), "text"))
        .when(kind == 6, lit(' {"winner": "B", "why": {"x": 1}} '))
        .when(kind == 7, lit('[{"winner": "A"}]'))
        .otherwise(lit('{"reason": "none"}'))
    )
    return _t(spark, sf, "documents").select(F.col("doc_id").alias("id"), response.alias("response"))


def parse_verdict_answers(spark, sf):
    v = parse_verdict(_verdict_responses(spark, sf))
    return v.select("id", "verdict", "judge_reason", "unparsed")


def _judged(spark, sf):
    return judge.unblind(_blind(spark, sf), _verdict_responses(spark, sf))


def position_swap(spark, sf):
    return _judged(spark, sf).select("id", "swapped", "judge_winner", F.md5("judge_prompt").alias("prompt_md5"))


def win_rates(spark, sf):
    return judge.win_rates(_judged(spark, sf))


def report_samples(spark, sf):
    return sampling.report_samples(_judged(spark, sf))


# --- scoring ----------------------------------------------------------------------


def _answers(spark, sf):
    d = _t(spark, sf, "documents")
    lang = F.col("lang")
    expected = (
        F.when(lang == "en", F.concat(F.lit("\t"), F.lower("text"), F.lit("\n ")))
        .when(lang == "de", F.expr("substring(text, 5)"))
        .when(lang == "es", F.lit("zzz"))
    )
    metric = F.element_at(
        F.array(*[F.lit(m) for m in ("exact_match", "substring", "llm_judge", "other")]),
        (F.substring("source", 4, 4).cast("int") % 4) + 1,
    )
    grade = F.when(F.col("doc_id") % 3 == 0, F.lit(" 1 yes")).otherwise(F.lit("0"))
    return d.select(
        "doc_id", F.col("source").alias("name"), metric.alias("metric_type"),
        F.col("text").alias("generated"), expected.alias("expected"), grade.alias("grade"),
    )


def _some(spark, sf, score):
    return _answers(spark, sf).filter(F.coalesce("expected", F.lit("")) != "").select("doc_id", score.alias("score"))


def score_exact(spark, sf):
    return _some(spark, sf, scoring.score_exact(F.col("generated"), F.col("expected")))


def score_substring(spark, sf):
    return _some(spark, sf, scoring.score_substring(F.col("generated"), F.col("expected")))


def score_graded(spark, sf):
    return _some(spark, sf, scoring.score_graded(F.col("grade")))


def benchmark_scores(spark, sf):
    answers = _answers(spark, sf)
    specs = answers.select("name", "metric_type").distinct()
    return scoring.benchmark_scores(specs, scoring.scored_rows(answers, grade="grade"))


def pick_metric(spark, sf):
    """Label averages per source as benchmark results, some without a normed score."""
    docs = _t(spark, sf, "documents").select("doc_id", "source", "lang")
    stats = docs.join(_t(spark, sf, "labels"), "doc_id").groupBy("source").agg(
        F.avg("quality").alias("q"), F.avg("toxic").alias("x"), F.count("*").alias("n")
    )

    def metric(key, value):
        return F.struct(F.lit(key).alias("key"), value.cast("double").alias("value"))

    plain = [metric("alias", F.lit(0)), metric("loss,none", F.col("x")), metric("acc,none", F.col("q"))]
    normed = plain + [metric("acc_norm,none", F.col("x"))]
    metrics = F.when(F.col("n") % 2 == 0, F.array(*normed)).otherwise(F.array(*plain))
    results = stats.select(F.col("source").alias("task"), metrics.alias("metrics"))
    known = docs.filter("lang = 'de'").select(F.col("source").alias("task")).distinct()
    return scoring.pick_metric(results, known.withColumn("display_name", F.upper("task")))


# --- performance and cost -----------------------------------------------------------


def _request_log(spark, sf):
    e = _t(spark, sf, "events")
    tokens = F.get_json_object("props", "$.k").cast("long")
    ms = F.expr("make_dt_interval(0, 0, 0, value / 1000)")
    return e.select(
        "event_id", F.col("event_type").alias("model"), F.col("user_id").alias("batch"),
        F.col("value").alias("total_ms"),
        F.when(F.col("event_id") % 4 != 0, F.col("value") / 8).alias("ttft_ms"),
        tokens.alias("output_tokens"),
        F.when(F.col("event_type") == "error", F.lit("HTTP 500")).alias("error"),
        F.col("ts").alias("started_at"), (F.col("ts") + ms).alias("ended_at"),
    )


def latency_percentiles(spark, sf):
    return perf.latency_percentiles(_request_log(spark, sf), ["model"], "total_ms")


def latency_sketch(spark, sf):
    """Percentiles from sketches stored per kind and day; whether each one's true rank is within the bound."""
    log = _request_log(spark, sf)
    stored = Workspace(spark).table(sketches.sketch_log(log, ["model"], ["total_ms"], "started_at"), "sketches")
    answers = sketches.sketch_percentiles(stored, ["model"], {"total_ms": perf.QUANTILES})
    checked = sketches.true_ranks(log, answers, ["model"], "total_ms")
    return checked.select("model", "q", "n", sketches.within_bound().alias("within"))


def request_summary(spark, sf):
    return perf.request_summary(_request_log(spark, sf))


def batch_throughput(spark, sf):
    return perf.batch_throughput(_request_log(spark, sf)).select("batch", "tokens", "tok_per_s")


def _costs(spark, sf):
    speed = perf.throughput_summary(_request_log(spark, sf))
    return perf.cost_comparison(speed.select("model", F.col("throughput_mean").alias("tok_per_s")))


def cost_comparison(spark, sf):
    return _costs(spark, sf).drop("provider_ord")


def headline_metrics(spark, sf):
    one = _request_log(spark, sf).withColumn("model", F.lit("all"))
    summary = perf.request_summary(one)
    speed = summary.select("model", F.col("throughput_mean").alias("tok_per_s"))
    return perf.headline_metrics(summary, perf.cost_comparison(speed), win_rates(spark, sf))


# --- whole runs ---------------------------------------------------------------------


def _enrich(spark, sf, **options):
    docs = _documents_gated(spark, sf).select("id", F.col("doc_id").alias("ord"), "messages")
    scores = _score_responses(spark, sf).withColumn("id", F.col("doc_id").cast("string")).drop("doc_id")
    variants = docs.select(
        "id", F.concat(F.lit("1. variant of "), "id", F.lit("\n2. another of "), "id").alias("response")
    )
    config = EnrichConfig(augment=True)
    return enrich(docs, scores, Workspace(spark), config, variants, **options)


def enrich_corpus(spark, sf):
    rows = _enrich(spark, sf).rows
    return rows.select("id", "split", F.col("_aug_source").alias("aug_source"), "text")


def enrich_duplicates(spark, sf):
    """Gated documents that an earlier one covers, and which."""
    found = _enrich(spark, sf).duplicates
    return found.select("id", F.col("rep_ord").cast("string").alias("covered_by"), F.round("similarity", 6).alias("similarity"))


def enrich_rejects(spark, sf):
    """Deduplicated documents below the quality threshold."""
    return _enrich(spark, sf).rejects.select("id", F.col("_quality.overall").alias("overall"))


def redact_model(spark, sf):
    """Documents redacted by a stand-in for a model that fails on some; both results."""

    def hide(text: str) -> str:
        if len(text) % 17 == 0:
            raise ValueError("no answer")
        return text.replace("e", "*")

    docs = _documents_gated(spark, sf).filter("route = 'kept'").select("id", "messages")
    ws = Workspace(spark)
    done, failed = redact_with_model(docs, hide, ws, backoff=0.0)
    text = chat.first_content(F.col("messages"), "user")
    return done.select("id", text.alias("text")).unionByName(failed.select("id", F.lit(None).cast("string").alias("text")))


def enrich_report(spark, sf):
    return _enrich(spark, sf).report


def stage_resume(spark, sf):
    """A stage run twice and once with another parameter; which runs did the work."""
    root = Workspace(spark).root
    docs = _t(spark, sf, "documents")
    mark = source_fingerprint(docs)
    out = None
    for run, limit in enumerate((40, 40, 400)):
        store = StageStore(spark, root)
        table, _ = store.run(
            "gate", mark, {"min": limit}, lambda: docs.filter(F.length("text") >= limit).select("doc_id", "lang")
        )
        part = table.groupBy("lang").agg(F.count("*").alias("rows")).withColumn("run", F.lit(run))
        part = part.withColumn("reused", F.lit(bool(store.reused)))
        out = part if out is None else out.unionByName(part)
    return out.select("run", "reused", "lang", "rows")


def model_calls(spark, sf):
    """A rule standing in for a model; some inputs always fail."""

    def answer(value: str) -> str:
        if len(value) % 13 == 0:
            raise ValueError("no answer")
        return str(len(value))

    docs = _documents(spark, sf)
    return apply_model(docs, answer, "text", "doc_id", backoff=0.0)


def incremental_refresh(spark, sf):
    """Documents arriving in three runs, a third without id, a third with text ids; what stays."""
    ws = Workspace(spark)
    inbox, out = ws.path("inbox"), ws.path("corpus")
    kind = F.col("doc_id") % 3
    name = F.when(kind == 0, F.concat(F.lit("d"), "doc_id")).when(kind == 1, F.col("doc_id").cast("string"))
    docs = _t(spark, sf, "documents").select(name.alias("id"), "text", F.col("doc_id").alias("position"))
    cuts = docs.approxQuantile("position", [1 / 3, 2 / 3], 0.01)
    part = sum(((F.col("position") > c).cast("int") for c in cuts), F.lit(0))
    for run in range(3):
        docs.filter(part == run).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("id string, text string, position long").parquet(inbox)
        start_refresh(
            stream, f"{ws.root}/store", out, f"{ws.root}/progress", order="position", keep=["position"]
        ).awaitTermination()
    kept = spark.read.option("basePath", out).parquet(out)
    unnamed = F.regexp_replace("id", "^[0-9]+-", "-")
    return kept.select(F.col("position").alias("doc_id"), unnamed.alias("id"), "text")


QUERIES = {
    "scan_jsonl": scan_jsonl,
    "scan_json_array": scan_json_array,
    "scan_csv": scan_csv,
    "scan_json_array_split": scan_json_array_split,
    "scan_csv_split": scan_csv_split,
    "scan_text_lines": scan_text_lines,
    "scan_text_file": scan_text_file,
    "load_eval_set": load_eval_set,
    "detect_format": detect_format,
    "discover_specs": discover_specs,
    "write_jsonl": write_jsonl,
    "rubric_prompt": rubric_prompt,
    "route_kept_rejected": route_kept_rejected,
    "normalize_schema": normalize_schema,
    "resolve_id": resolve_id,
    "fold_turns": fold_turns,
    "length_gate": length_gate,
    "funnel_counts": funnel_counts,
    "row_text": row_text,
    "review_text": review_text,
    "render_chat": render_chat,
    "chat_template": chat_template,
    "render_prompt": render_prompt,
    "first_turns": first_turns,
    "render_template": render_template,
    "tag_domain": tag_domain,
    "pick_metric": pick_metric,
    "scrub_text": scrub_text,
    "scrub_messages": scrub_messages,
    "pii_counts": pii_counts,
    "redact_corpus": redact_corpus,
    "embed_text": embed_text,
    "l2_normalize": l2_norm,
    "cosine_pairs": cosine_pairs,
    "cosine_pairs_banded": cosine_pairs_banded,
    "cosine_pairs_balls": cosine_pairs_balls,
    "leader_clusters": leader_cluster_ids,
    "embedding_dedup": embedding_dedup,
    "exact_dedup": exact_dedup,
    "semantic_dedup": semantic_dedup,
    "dedup_stats": dedup_stats,
    "parse_scores": parse_score_answers,
    "quality_filter": quality_filter,
    "score_histogram": score_histogram,
    "clean_variants": variant_lines,
    "augment_rows": augment_rows,
    "seeded_sample": seeded_sample,
    "train_eval_split": train_eval_split,
    "split_report": split_report,
    "head_rows": head_rows,
    "report_samples": report_samples,
    "pack_sequences": pack_sequences,
    "pair_outputs": pair_outputs,
    "unpaired_rows": unpaired_rows,
    "parse_verdict": parse_verdict_answers,
    "position_swap": position_swap,
    "win_rates": win_rates,
    "score_exact": score_exact,
    "score_substring": score_substring,
    "score_graded": score_graded,
    "benchmark_scores": benchmark_scores,
    "latency_percentiles": latency_percentiles,
    "latency_sketch": latency_sketch,
    "request_summary": request_summary,
    "batch_throughput": batch_throughput,
    "cost_comparison": cost_comparison,
    "headline_metrics": headline_metrics,
    "enrich_corpus": enrich_corpus,
    "enrich_duplicates": enrich_duplicates,
    "enrich_rejects": enrich_rejects,
    "enrich_report": enrich_report,
    "redact_model": redact_model,
    "stage_resume": stage_resume,
    "apply_model": model_calls,
    "incremental_refresh": incremental_refresh,
}
