"""The whole corpus preparation: gate, dedup, quality, redaction, split, augmentation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.chat import CHATML, ChatTemplate, first_content, render_chat, review_text, row_text
from turnmill.functions.pii import REDACT_RULES, redact_messages
from turnmill.functions.vectors import embed_with_model
from turnmill.operators.augment import augment_rows
from turnmill.operators.judge import assert_unique
from turnmill.operators.model_apply import apply_model, redact_with_model
from turnmill.operators.normalize import funnel_columns, length_gate
from turnmill.operators.quality import attach_scores, quality_filter, rubric_prompt
from turnmill.operators.sampling import EVAL_RATIO, train_eval_split
from turnmill.operators.semantic import DEFAULT_THRESHOLD, dedup_columns, embedding_dedup, semantic_dedup
from turnmill.operators.skew import without
from turnmill.plans.stages import StageStore
from turnmill.schema import MAX_CHARS, MIN_CHARS
from turnmill.workspace import Workspace


@dataclass(frozen=True)
class EnrichConfig:
    """Step switches and thresholds; augmentation is off unless asked for."""

    dedup: bool = True
    quality_filter: bool = True
    redact: bool = True
    augment: bool = False
    dedup_threshold: float = DEFAULT_THRESHOLD
    quality_min_overall: int = 3
    augment_variants_per_row: int = 2
    eval_ratio: float = EVAL_RATIO


@dataclass(frozen=True)
class EnrichModels:
    """User models that take the place of rules and prepared tables; all are optional.

    ``embed`` makes a batch embedding function (see ``embed_with_model``) and replaces word
    bigrams in dedup; ``review`` answers a rubric prompt and replaces ``scores``; ``redact``
    rewrites one message and replaces the rules; ``paraphrase`` answers with one variant
    per line and replaces ``variants``. ``rubric`` and ``domain`` shape the review.
    """

    embed: Callable | None = None
    review: Callable[[str], str] | None = None
    redact: Callable[[str], str] | None = None
    paraphrase: Callable[[str], str] | None = None
    rubric: str = "Rate this conversation from 1 to 5. Answer with JSON: overall, reason."
    domain: str | None = None
    version: str = ""


@dataclass
class EnrichResult:
    """Final rows, the reports, and what the steps left out.

    ``duplicates`` carry the row that covers them, ``rejects`` their score;
    ``quarantined`` holds the ids of rows that the redaction model failed on.
    """

    rows: DataFrame
    report: DataFrame
    duplicates: DataFrame | None = None
    rejects: DataFrame | None = None
    quarantined: DataFrame | None = None


def long_report(stage: str, one_row: DataFrame) -> DataFrame:
    """A one-row report as ``stage, metric, value``."""
    names = one_row.columns
    pairs = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    )
    return one_row.select(F.explode(pairs).alias("m")).select(
        F.lit(stage).alias("stage"), "m.metric", "m.value"
    )


def enrich(
    conversations: DataFrame,
    scores: DataFrame | None,
    ws: Workspace,
    config: EnrichConfig = EnrichConfig(),
    variants: DataFrame | None = None,
    template: ChatTemplate | Callable[..., Column] = CHATML,
    stages: StageStore | None = None,
    sources: Mapping[str, str] | None = None,
    models: EnrichModels = EnrichModels(),
) -> EnrichResult:
    """Run the configured steps over ``id, ord, messages`` (``ord`` long; both unique).

    Every step is written once, its report is observed on that write, and the next step reads it. With
    ``stages`` the tables are kept under their fingerprint, so a repeated run only
    redoes steps whose input or parameters changed; ``sources`` then names the
    fingerprint of each input table (``conversations``, ``scores``, ``variants``), and
    ``models`` need a version; a repeated run then calls no model. The split comes after redaction, so evaluation rows are deduplicated and redacted too,
    and the text is rendered last, from the final messages. A repeated id fails the run.
    """
    reports = []
    if config.quality_filter and scores is None and models.review is None:
        raise ValueError("the quality filter needs scores or a review model")
    needed = {"conversations"}
    needed |= {"scores"} if config.quality_filter and models.review is None else set()
    needed |= {"variants"} if config.augment and variants is not None else set()
    if stages is not None and needed - set(sources or {}):
        raise ValueError(f"stages need a fingerprint of {sorted(needed - set(sources or {}))}")
    if stages is not None and not models.version and any((models.embed, models.review, models.redact, models.paraphrase)):
        raise ValueError("stages need the version of the models")
    marks = dict(sources or {})
    mark = marks.get("conversations", "")

    def step(name: str, params: dict, build, metrics: Sequence[Column] = ()) -> DataFrame:
        """A stage's table; its metrics are observed as it is written, and go to the report."""
        nonlocal mark
        if stages is not None:
            table, mark = stages.run(name, mark, params, build, metrics)
            values = stages.metrics.get(name, {})
        elif metrics:
            table, values = ws.observed(build(), name, metrics)
        else:
            table, values = ws.table(build(), name), {}
        reports.extend((name, k, float(v)) for k, v in values.items())
        return table

    gate = {"min_chars": MIN_CHARS, "max_chars": MAX_CHARS}
    gated = step("gate", gate, lambda: length_gate(assert_unique(conversations, "id")), funnel_columns())
    rows = gated.filter("route = 'kept'").select("id", "ord", "messages")
    duplicates = rejects = None

    if config.dedup:
        before = rows
        clusters = step(
            "dedup",
            {"threshold": config.dedup_threshold, "embed": models.version if models.embed else None},
            lambda: _deduplicated(before, ws, config.dedup_threshold, models),
            dedup_columns(config.dedup_threshold),
        )
        covered = clusters.filter("state <> 'kept'")
        duplicates = before.join(covered, "ord")
        rows = without(rows, "ord", covered.select("ord"), covered.count())

    if config.quality_filter:
        unscored = rows
        scored = step(
            "quality",
            {
                "min_overall": config.quality_min_overall, "scores": marks.get("scores"),
                "review": [models.version, models.rubric, models.domain] if models.review else None,
            },
            lambda: quality_filter(
                attach_scores(unscored, _reviewed(unscored, ws, models) if models.review else scores),
                config.quality_min_overall,
            ),
            _quality_columns(),
        )
        rejects = scored.filter("route = 'rejected'").drop("route")
        rows = scored.filter("route = 'kept'").drop("route")

    quarantined = None
    if config.redact and models.redact:
        readable = rows

        def redacted() -> DataFrame:
            out, bad = redact_with_model(readable, models.redact, ws)
            held = readable.join(bad, "id", "left_semi").withColumn("messages", F.lit(None).cast(readable.schema["messages"].dataType))
            kept = out.withColumn("route", F.lit("kept"))
            return kept.unionByName(held.withColumn("route", F.lit("quarantined")))

        done = step("redact", {"model": models.version}, redacted)
        rows = done.filter("route = 'kept'").drop("route")
        quarantined = done.filter("route = 'quarantined'").select("id")
    elif config.redact:
        rows = rows.withColumn("messages", redact_messages(F.col("messages")))

    unsplit = rows
    rows = step(
        "split",
        {
            "ratio": config.eval_ratio, "redact": REDACT_RULES if config.redact and not models.redact else None,
        },
        lambda: train_eval_split(unsplit, config.eval_ratio),
        [F.count("*").alias("rows")],
    )
    if config.augment and (variants is not None or models.paraphrase):
        unaugmented = rows

        def augmented() -> DataFrame:
            train, held_out = (unaugmented.filter(F.col("split") == s) for s in ("train", "eval"))
            made = _paraphrased(train, ws, models.paraphrase) if models.paraphrase else variants
            new = augment_rows(train, made, config.augment_variants_per_row)
            return new.unionByName(held_out.withColumn("_aug_source", F.lit(None).cast("string")))

        rows = step(
            "augment",
            {
                "per_row": config.augment_variants_per_row, "variants": marks.get("variants"),
                "model": models.version if models.paraphrase else None,
            },
            augmented,
            [
                F.count_if((F.col("split") == "train") & F.col("_aug_source").isNull()).alias("input_rows"),
                F.count_if(F.col("split") == "train").alias("output_rows"),
                F.count("*").alias("rows"),
            ],
        )
    rows = rows.withColumn("text", render_chat(F.col("messages"), template))
    # The last stage's rows are the final ones; counts of rows by stage are not part of the report.
    final = [value for _, metric, value in reports if metric == "rows"][-1]
    reports = [r for r in reports if r[1] != "rows"] + [("final", "rows", final)]
    reports += [("config", name, float(value)) for name, value in asdict(config).items()]
    report = rows.sparkSession.createDataFrame(reports, "stage string, metric string, value double")
    return EnrichResult(rows, report, duplicates, rejects, quarantined)


def _quality_columns() -> list[Column]:
    """Counts of the quality filter, and of rows per overall score, held within 1 to 5."""
    overall = F.greatest(F.lit(1), F.least(F.lit(5), F.col("_quality.overall")))
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("route") == "kept").alias("kept"),
        F.count_if(F.col("route") == "rejected").alias("rejected"),
        *[F.count_if(overall == i).alias(f"score_{i}") for i in range(1, 6)],
    ]


def _deduplicated(rows: DataFrame, ws: Workspace, threshold: float, models: EnrichModels) -> DataFrame:
    texts = rows.select("ord", row_text(F.col("messages")).alias("text"))
    if models.embed is None:
        return semantic_dedup(texts, ws, "ord", "text", threshold, cluster_ids=False)
    vectors = ws.table(texts.select("ord", embed_with_model(F.col("text"), models.embed).alias("embedding")), "embedded")
    return embedding_dedup(vectors, ws, "ord", "embedding", threshold).drop("cluster_id")


def _reviewed(rows: DataFrame, ws: Workspace, models: EnrichModels) -> DataFrame:
    asked = F.concat(F.lit(rubric_prompt(models.rubric, models.domain) + "\n\n"), review_text(F.col("messages")))
    return ws.table(apply_model(rows.select("id", asked.alias("asked")), models.review, "asked"), "reviews")


def _paraphrased(rows: DataFrame, ws: Workspace, paraphrase: Callable[[str], str]) -> DataFrame:
    asked = rows.select("id", first_content(F.col("messages"), "user").alias("asked")).filter("asked IS NOT NULL")
    return ws.table(apply_model(asked, paraphrase, "asked").select("id", "response"), "paraphrases")
