"""Run a user's model over prompts, and train a simple classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docflow.functions.rows import token_rows
from docflow.session import scratch_path
from docflow.sinks.tables import materialise

ROWS_AT_ONCE = 256
FREQUENT = 1 << 16  # words whose weights go to all tasks; the others are joined

# Builds one client per Python worker. The client maps a prompt (and file bytes, if asked for) to text.
ModelFactory = Callable[[], Callable[..., "str | None"]]


def prompt(template: str, **parts: str | Column) -> Column:
    """Fill ``{name}`` places of a template from columns, e.g. ``prompt("Translate to {lang}: {text}", ...)``."""
    out = F.lit(template)
    for name, value in parts.items():
        col = F.col(value) if isinstance(value, str) else value
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(col.cast("string"), F.lit("")))
    return out


def hash_batch(key: str | Column, n: int) -> Column:
    """Batch number 0..n-1 of a row from its key: even batches without counting or sorting the table."""
    col = F.col(key) if isinstance(key, str) else key
    code = F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(code, F.lit(n))


def _call_model(factory: ModelFactory, fields: list[str], fail_on_error: bool):
    """Calls in slices of a batch. Prompts and file bytes are not sent back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()
        for batch in batches:
            kept = [c for c in batch.schema.names if c not in ("_prompt", "_file")]
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                results, errors = [], []
                for row in zip(*[part.column(f) for f in fields]):
                    try:
                        if not row[0].is_valid:
                            raise ValueError("no prompt")
                        results.append(client(*[v.as_py() for v in row]))
                        errors.append(None)
                    except Exception as err:
                        if fail_on_error:
                            raise
                        results.append(None)
                        errors.append(f"{type(err).__name__}: {err}")
                answers = [pa.array(results, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *answers], names=[*kept, "result", "error_message"])

    return run


def model_enrich(
    df: DataFrame,
    prompt_col: str | Column,
    model: ModelFactory,
    schema: str | None = None,
    fail_on_error: bool = False,
    max_chars: int | None = None,
    files_col: str | None = None,
    dedupe: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``result`` and ``error_message`` from a model call per row.

    Equal prompts are sent once: distinct prompts are hashed apart, called in Arrow batches, and joined back on the
    hash, so a prompt shared by a third of all rows costs one call. With ``files_col`` each row is its own call.
    ``schema`` parses the answer; an answer that does not fit it is an error. Errors are per row, unless
    ``fail_on_error``. ``partitions`` bounds the number of clients.
    """
    text = F.col(prompt_col) if isinstance(prompt_col, str) else prompt_col
    if max_chars is not None:
        text = F.left(text, F.lit(max_chars))
    if files_col is not None:
        rows = df.withColumn("_prompt", text).withColumnRenamed(files_col, "_file")
        return _parse_result(rows.mapInArrow(_call_model(model, ["_prompt", "_file"], fail_on_error), _answered(rows)), schema)
    if not dedupe:
        rows = df.withColumn("_prompt", text)
        return _parse_result(rows.mapInArrow(_call_model(model, ["_prompt"], fail_on_error), _answered(rows)), schema)
    mark = F.coalesce(F.sha2("_prompt", 256), F.lit(""))
    keyed = df.withColumn("_prompt", text).withColumn("_hash", mark)
    distinct = keyed.select("_hash", "_prompt").dropDuplicates(["_hash"])
    if partitions:
        distinct = distinct.repartition(partitions, "_hash")
    answers = distinct.mapInArrow(_call_model(model, ["_prompt"], fail_on_error), _answered(distinct))
    return _parse_result(keyed.drop("_prompt").join(answers, "_hash", "left").drop("_hash"), schema)


def _answered(rows: DataFrame) -> StructType:
    kept = [f for f in rows.schema.fields if f.name not in ("_prompt", "_file")]
    return StructType([*kept, StructField("result", StringType()), StructField("error_message", StringType())])


def translate(df: DataFrame, text: str, lang: str, target: str, model: ModelFactory, template: str | None = None, **options) -> DataFrame:
    """Add ``result`` in the target language. Rows that are in it already keep their text and are not sent."""
    asked = template or "Translate from {lang} to {target}: {text}"
    foreign = df.filter(~F.col(lang).eqNullSafe(F.lit(target)))
    sent = model_enrich(foreign, prompt(asked, lang=lang, target=F.lit(target), text=text), model, **options)
    same = df.filter(F.col(lang).eqNullSafe(F.lit(target)))
    return sent.unionByName(same.withColumn("result", F.col(text)).withColumn("error_message", F.lit(None).cast("string")))


def _parse_result(df: DataFrame, schema: str | None) -> DataFrame:
    if schema is None:
        return df
    value = F.from_json("result", schema, {"mode": "PERMISSIVE"})
    bad = F.col("result").isNotNull() & F.try_parse_json("result").isNull()
    return (
        df.withColumn("_value", F.when(~bad, value))
        .withColumn("error_message", F.coalesce("error_message", F.when(bad, "answer does not fit the schema")))
        .drop("result")
        .withColumnRenamed("_value", "result")
    )


def train_label_model(df: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 14):
    """Fit a naive Bayes classifier on labelled text. Returns a pipeline model that adds ``prediction``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}]+"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        NaiveBayes(featuresCol="_tf", labelCol=label),
    ]
    return Pipeline(stages=stages).fit(df)


def label_by_words(docs: DataFrame, labelled: DataFrame, text: str = "text", key: str = "doc_id", label: str = "label") -> DataFrame:
    """``key, label``: multinomial naive Bayes over words, from plain aggregates.

    Word counts get one added (Laplace). Words that no labelled text has say nothing; scores are compared at 6 digits,
    ties go to the smaller label. The weights of the ``FREQUENT`` most frequent words are a bounded list that goes to all
    tasks, where their sums stay in the row's partition; only rare words are joined. One row per label reaches the driver.
    """
    counted = token_rows(labelled, text, keep=[label]).groupBy(label, "term").agg(F.count("*").alias("c"))
    words = materialise(counted, scratch_path(docs.sparkSession, "label-words"))
    sizes = words.groupBy(label).agg(F.sum("c").alias("n"))
    classes = labelled.groupBy(label).agg(F.count("*").alias("docs")).join(sizes, label, "left").orderBy(label).collect()
    merged = words.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct(label, "c"))).alias("m"), F.sum("c").alias("c"))
    vocabulary, total = merged.count(), sum(r["docs"] for r in classes)
    logs = [
        F.log((F.coalesce(F.element_at("m", F.lit(r[label])), F.lit(0)) + 1.0) / F.lit(float((r["n"] or 0) + vocabulary))).alias(f"s{i}")
        for i, r in enumerate(classes)
    ]
    places = [f"s{i}" for i in range(len(classes))]
    known = materialise(merged.select("term", "c", *logs), scratch_path(docs.sparkSession, "label-weights"))
    frequent = known.orderBy(F.desc("c"), "term").limit(FREQUENT).select("term", F.struct(*places).alias("w"))
    marked = token_rows(docs, text, keep=[key]).join(F.broadcast(frequent), "term", "left")
    rare = marked.filter("w IS NULL").select(key, "term").join(known, "term").select(key, *places)
    weights = marked.filter("w IS NOT NULL").select(key, "w.*").unionByName(rare)
    scored = docs.select(key).distinct().join(weights.groupBy(key).agg(*[F.sum(c).alias(c) for c in places]), key, "left")
    ranked = [
        F.struct((-F.round(F.coalesce(f"s{i}", F.lit(0.0)) + F.log(F.lit(r["docs"] / total)), 6)).alias("s"), F.lit(r[label]).alias("l"))
        for i, r in enumerate(classes)
    ]
    return scored.select(key, F.array_min(F.array(*ranked))["l"].alias(label))


def embed_text(df: DataFrame, text: str = "text", key: str = "doc_id", features: int = 256) -> DataFrame:
    """``df`` with ``embedding``, an ``array<double>`` of hashed TF-IDF weights; a text without words has zeros.

    Counts of a document's hash places are combined inside it; the frequencies of the places are ``features`` numbers.
    """
    place = F.pmod(F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("bigint"), F.lit(features)).cast("int")
    tf = token_rows(df, text, keep=[key]).groupBy(key, place.alias("place")).agg(F.count("*").alias("tf"))
    counted = tf.groupBy("place").agg(F.count_if(F.col("tf") > 0).alias("f"))
    frequency = counted.agg(F.map_from_entries(F.collect_list(F.struct("place", "f"))).alias("m")).scalar()
    total = df.agg(F.count("*").alias("n")).scalar()
    weight = F.col("tf") * F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.element_at(frequency, F.col("place"))))
    rows = tf.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("place", F.round(weight, 6)))).alias("_w"))
    places = F.sequence(F.lit(0), F.lit(features - 1))
    dense = F.transform(places, lambda i: F.coalesce(F.element_at("_w", i.cast("int")), F.lit(0.0)))
    return df.join(rows, key, "left").withColumn("embedding", dense).drop("_w")
