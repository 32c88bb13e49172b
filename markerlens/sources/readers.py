"""Readers (SRC-1 … SRC-16): every input the reference loads, as a Spark read with a schema.

Nothing is gathered on the driver: per-file decisions (which physical row is the header) are
a small per-file table joined back, and per-row reshaping is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from markerlens.functions import text as T

TAGS = T.TAGS
SPAN = Ty.StructType([Ty.StructField("text", Ty.StringType()), Ty.StructField("start", Ty.IntegerType()),
                      Ty.StructField("end", Ty.IntegerType())])
SPANS = Ty.ArrayType(SPAN)


def read_manifest(spark: SparkSession, path: str, path_col: str = "url") -> DataFrame:
    """SRC-1 only the path column of a manifest CSV, blanks trimmed."""
    df = spark.read.option("header", True).csv(path)
    return df.select(T.strip_ws(path_col).alias(path_col)).where(F.length(path_col) > 0)


def _file_ordinal(df: DataFrame) -> DataFrame:
    """Per-file physical row number. Multi-line CSV files are not split, so one file is one
    task and the row ids inside it follow file order."""
    d = df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_mid", F.monotonically_increasing_id())
    first = d.groupBy("_file").agg(F.min("_mid").alias("_m0"))
    # one row per file: broadcast
    return d.join(F.broadcast(first), "_file").withColumn("_row", F.col("_mid") - F.col("_m0")).drop("_mid", "_m0")


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(source_file, rec, record, width): the records of CSV files as text, numbered from 0 in each file.

    A record ends with a line after which all quotes are closed, so the number of quotes in a file up to a line tells
    where records start; that count and the numbering are one window over a file's lines (short rows, sorted and spilled by Spark, and a
    file is never one row). Blank lines between records don't count; line ends inside quotes become ``\\n``."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = (spark.read.option("lineSep", "\n").text(paths)
             .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_mid"), F.regexp_replace("value", "\r$", "").alias("value")))
    order = Window.partitionBy("source_file").orderBy("_block", "_mid")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    before = F.coalesce(F.sum(quotes).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.when((before % 2 == 0) & (F.trim("value") != ""), 1).otherwise(0)
    numbered = (lines.withColumn("_inside", before % 2 == 1).withColumn("_start", starts)
                .withColumn("rec", F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
                .where(F.col("_inside") | (F.col("_start") == 1)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_mid", "value"))), lambda x: x["value"]), "\n")
    records = numbered.groupBy("source_file", "rec").agg(text.alias("record"))
    # outside quotes every comma parts two fields; a doubled quote is two quoted pieces side by side
    bare = F.regexp_replace("record", '"[^"]*"', "")
    return records.withColumn("width", F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1)


def csv_headers(records: DataFrame, wanted: Sequence[str], look: int = 2) -> DataFrame:
    """(source_file, header_row, names, ok): the first of a file's first ``look`` records that holds all ``wanted`` names, else
    the first one, and whether it holds them."""
    first = records.where(F.col("rec") < look)
    widest = first.agg(F.max("width")).first()[0] or 1
    names = F.transform(_fields("record", widest), F.trim)
    ok = F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col("names"))) == 0
    best = F.min(F.struct(~F.col("ok"), F.col("rec"), F.col("names"), F.col("ok")))
    return (first.select("source_file", "rec", F.filter(names, lambda n: n.isNotNull()).alias("names")).withColumn("ok", ok)
            .groupBy("source_file").agg(best.alias("b"))
            .select("source_file", F.col("b.rec").alias("header_row"), F.col("b.names").alias("names"), F.col("b.ok").alias("ok")))


def _fields(record: str, width: int) -> Column:
    """A record's first ``width`` fields as an array; those that it doesn't have are null."""
    schema = ", ".join(f"c{k} string" for k in range(width))
    row = F.from_csv(F.col(record), F.lit(schema), {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "maxColumns": str(width + 1)})
    return F.array(*[row[f"c{k}"] for k in range(width)])


def csv_files(spark: SparkSession, path: str | Sequence[str], wanted: Sequence[str] = ("text", "label"), look: int = 2) -> DataFrame:
    """(source_file, ok, reason) for every file, also empty ones: whether ``read_csv_detect_header`` can read it."""
    paths = [path] if isinstance(path, str) else list(path)
    # the file index that the reader keeps on the driver anyway; a scan would leave out empty files
    names = spark.read.format("binaryFile").load(paths).inputFiles()
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  one spelling of local paths
    files = spark.createDataFrame([(n,) for n in names], "source_file string").withColumn("source_file", same("source_file"))
    heads = csv_headers(csv_records(spark, paths), wanted, look).withColumn("source_file", same("source_file"))
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col("names"))
    reason = (F.when(F.col("ok").isNull(), "no records")
              .when(~F.col("ok"), F.concat(F.lit("columns missing: "), F.array_join(missing, ", "))))
    return files.join(heads, "source_file", "left").select("source_file", F.coalesce("ok", F.lit(False)).alias("ok"), reason.alias("reason"))


def read_csv_detect_header(spark: SparkSession, path: str | Sequence[str], wanted: Sequence[str] = ("text", "label"),
                           look: int = 2) -> DataFrame:
    """SRC-2 per file, the first of the first ``look`` records holding all ``wanted`` names is the header; rows after it
    are kept, projected to ``wanted`` by the header's positions, whatever the widths of the files. Adds ``source_file`` and ``source_row``
    (the record's number in its file). Files without such a header give no rows (``csv_files`` names them)."""
    records = csv_records(spark, path)
    heads = csv_headers(records, wanted, look).where("ok")
    place = [F.array_position("names", w).cast("int").alias(f"_p{k}") for k, w in enumerate(wanted)]
    heads = heads.select("source_file", "header_row", *place)
    most = heads.agg(F.max(F.greatest(*[f"_p{k}" for k in range(len(wanted))], F.lit(1)))).first()[0] or 1
    body = records.join(heads, "source_file").where(F.col("rec") > F.col("header_row")).withColumn("_f", _fields("record", most))
    return body.select(*[F.get("_f", F.col(f"_p{k}") - 1).alias(w) for k, w in enumerate(wanted)], "source_file", F.col("rec").alias("source_row"))


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12 clean-corpus CSV whose first header is blank: ``_c0`` becomes ``id``; a blank id
    falls back to the row's ordinal in the file."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    first = df.columns[0]
    d = _file_ordinal(df.select("*", "_metadata"))
    return d.select(F.coalesce(F.col(first).try_cast("long"), F.col("_row")).alias("id"), "text",
                    F.col("label").try_cast("int").alias("label"))


def lenient_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRC-9 listed fields as int where they parse (``{c}``), the text kept in ``{c}_raw``;
    blanks stay null."""
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_raw", F.col(c)).withColumn(c, F.col(c).try_cast("int"))
    return out


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10 all columns as strings."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def positional_subset(df: DataFrame, n: int = 4) -> DataFrame:
    """SRC-14 the first ``n`` columns."""
    return df.select(*df.columns[:n])


def title_body(df: DataFrame, title: str = "title", body: str = "text") -> DataFrame:
    """SRC-16 ``title + ' ' + text``; null when either is null (``concat``, not ``concat_ws``)."""
    return df.withColumn(body, F.concat(F.col(title), F.lit(" "), F.col(body)))


# ---------------------------------------------------------------- annotation exports

EXPORT_SCHEMA = Ty.StructType([
    Ty.StructField("id", Ty.LongType()),
    Ty.StructField("annotations", Ty.ArrayType(Ty.StructType([
        Ty.StructField("result", Ty.ArrayType(Ty.StructType([
            Ty.StructField("value", Ty.StructType([
                Ty.StructField("start", Ty.IntegerType()), Ty.StructField("end", Ty.IntegerType()),
                Ty.StructField("text", Ty.StringType()),
                Ty.StructField("labels", Ty.ArrayType(Ty.StringType()))]))])))]))),
    Ty.StructField("data", Ty.MapType(Ty.StringType(), Ty.StringType())),
])


def read_span_export(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7 span-annotation export files (a JSON array of records); empty files give no rows."""
    return spark.read.schema(EXPORT_SCHEMA).option("multiLine", True).json(path)


def _truthy_id(c: Column) -> Column:
    v = c.try_cast("long")
    return F.when(v != 0, v)


def flatten_span_export(df: DataFrame, tags: Sequence[str] = TAGS) -> DataFrame:
    """AGG-14 / FN-1 / FN-3 / FLT-8 one flat row per record: ID (first truthy of
    ``Unnamed: 0``, ``id``, ``ID``), Text, doc_label and, per known tag, the spans of
    the record's first annotation (unknown labels ignored). No shuffle."""
    results = F.coalesce(F.get(F.col("annotations"), 0)["result"], F.array().cast(
        Ty.ArrayType(EXPORT_SCHEMA["annotations"].dataType.elementType["result"].dataType.elementType)))
    data = F.col("data")
    ident = F.coalesce(_truthy_id(data["Unnamed: 0"]), _truthy_id(data["id"]), data["ID"].try_cast("long"))
    cols = [ident.alias("ID"), F.coalesce(data["text"], data["Text"]).alias("Text"),
            data["label"].try_cast("int").alias("doc_label")]
    for tag in tags:
        hits = F.filter(results, lambda r: F.array_contains(r["value"]["labels"], tag))
        cols.append(F.transform(hits, lambda r: F.struct(r["value"]["text"].alias("text"),
                                                         r["value"]["start"].alias("start"),
                                                         r["value"]["end"].alias("end"))).alias(tag))
    return df.select(*cols)


def read_annotators(spark: SparkSession, glob: str | Sequence[str], suffix: str = "_annotations_cleaned.json",
                    tags: Sequence[str] = TAGS, lines: bool = False, repair_ids: bool = False) -> DataFrame:
    """SRC-8 many annotators' flat files → long ratings (annotator, item_id, text, feature, spans, category).

    The annotator is the name of the file, or of the folder that Spark wrote in its place, minus ``suffix``. Files hold
    one JSON array, or with ``lines`` one record a line; a record is a row either way. Of records with the same annotator, id and text the first one
    stays. A null id stays null (``without_id`` puts such rows aside), or becomes 0 with ``repair_ids`` (FN-2).
    Spans arrive as mixed arrays ``[text, start, end]``, also with numbers as text.
    """
    keys = ("ID", "id", "Unnamed: 0", "Text", "text")
    # these names differ in case only, which this session alone has to tell apart
    exact = spark.newSession()
    exact.conf.set("spark.sql.caseSensitive", "true")
    schema = Ty.StructType([Ty.StructField(k, Ty.StringType()) for k in (*keys, *tags)])
    raw = exact.read.schema(schema).option("multiLine", not lines).json([glob] if isinstance(glob, str) else list(glob))
    name = F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+){suffix.replace('.', chr(92) + '.')}(?:/[^/]*)?$", 1)
    item = F.coalesce(F.col("ID"), F.col("id"), F.col("`Unnamed: 0`")).try_cast("long")
    recs = raw.select(F.url_decode(name).alias("annotator"), (F.coalesce(item, F.lit(0)) if repair_ids else item).alias("item_id"),
                      F.coalesce(F.col("Text"), F.col("text")).alias("text"), F.struct(*tags).alias("_tags"),
                      F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_mid"))
    first = Window.partitionBy("annotator", "item_id", F.sha2("text", 256)).orderBy("_file", "_block", "_mid")
    recs = recs.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")
    arr = Ty.ArrayType(Ty.ArrayType(Ty.StringType()))
    per_tag = F.array(*[F.struct(F.lit(t).alias("feature"),
                                 spans_from_arrays(F.from_json(F.col("_tags")[t], arr)).alias("spans")) for t in tags])
    long = recs.select("annotator", "item_id", "text", F.inline(per_tag))
    return long.withColumn("category", F.when(F.col("spans").isNotNull(), T.spans_key("spans")))


def without_id(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings with an item id, and those without one, which nothing can align."""
    return ratings.where(F.col("item_id").isNotNull()), ratings.where(F.col("item_id").isNull())


def spans_from_arrays(c: Column) -> Column:
    """SRC-13 mixed arrays ``[text, start, end]`` → ``array<struct<text,start,end>>``."""
    return F.transform(c, lambda a: F.struct(a[0].alias("text"), a[1].try_cast("int").alias("start"),
                                             a[2].try_cast("int").alias("end")))


def read_consolidated(spark: SparkSession, path: str, tags: Sequence[str] = TAGS, label_key: str = "label") -> DataFrame:
    """SRC-13 consolidated annotations: JSON array of flat rows with mixed-array spans; ``label_key`` is the file's
    name of the label, here ``doc_label``."""
    fields = [Ty.StructField("ID", Ty.LongType()), Ty.StructField("Text", Ty.StringType()),
              Ty.StructField(label_key, Ty.StringType()), Ty.StructField("Annotator", Ty.StringType())]
    fields += [Ty.StructField(t, Ty.ArrayType(Ty.ArrayType(Ty.StringType()))) for t in tags]
    df = spark.read.schema(Ty.StructType(fields)).option("multiLine", True).json(path)
    return df.select("ID", "Text", F.col(label_key).alias("doc_label"), "Annotator",
                     *[spans_from_arrays(F.col(t)).alias(t) for t in tags])


# ---------------------------------------------------------------- other inputs

def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6 landed news-feed XML: one row per ``<item>``: (url = link, text = title, label = 0).
    Malformed records are dropped; an empty feed gives no rows."""
    schema = Ty.StructType([Ty.StructField("title", Ty.StringType()), Ty.StructField("link", Ty.StringType())])
    df = (spark.read.format("xml").option("rowTag", "item").option("mode", "DROPMALFORMED")
          .schema(schema).load(path))
    return df.where(F.col("link").isNotNull()).select(
        T.strip_ws("link").alias("url"), F.col("title").alias("text"), F.lit(0).alias("label"))


def read_word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """SRC-11 ``token v1 … v_dim`` lines; an optional ``count dim`` header line is dropped and
    lines whose vector length is not ``dim`` are dropped."""
    lines = spark.read.text(path).select(F.split(F.regexp_replace("value", "\\s+$", ""), " ").alias("p"))
    header = (F.size("p") == 2) & F.col("p")[0].rlike("^[0-9]+$") & F.col("p")[1].rlike("^[0-9]+$")
    vec = F.transform(F.slice("p", 2, F.size("p")), lambda x: x.cast("float"))
    return (lines.where(~header).select(F.col("p")[0].alias("token"), vec.alias("vector"))
            .where(F.size("vector") == dim))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15 lexicon text file: ``#`` lines name the section of the words below them.
    A lexicon file is small (one partition); the section is the last header above a line."""
    raw = spark.read.text(path).coalesce(1).withColumn("_n", F.monotonically_increasing_id())
    hdr = F.when(F.col("value").startswith("#"), F.trim(F.regexp_replace("value", "^#+", "")))
    w = Window.orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    tagged = raw.withColumn("category", F.last(hdr, ignorenulls=True).over(w))
    return (tagged.where(~F.col("value").startswith("#") & (F.length(F.trim("value")) > 0))
            .select("category", F.lower(F.trim("value")).alias("term")))
