"""Movie medallion pipeline: raw JSON documents -> bronze -> silver + lookups,
quarantine, status merge and repair.

Raw documents are derived from ``part`` (so the work grows with the tables):
``Id`` = p_partkey, ``Title`` = p_name, language cycles over four codes, some
release dates / run times are missing, zero or negative, and the genres are the
words of the name. Rows whose Id ends in 0 are delivered twice.
"""
from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.dates import ts_lit
from ..operators.aggregates import dedup_keep_first
from ..operators.keys import add_surrogate_key
from ..operators.projection import map_columns, mark_rows
from ..operators.merge import apply_actions_to, apply_merge, create_partitioned_table, merge_update, merge_upsert
from ..operators.versions import replace_table
from ..operators.split import split_rows
from ..schemas import MOVIE, assert_schema, parse_ddl
from ..session import new_database, new_run_dir
from ..sources.files import read_json_array, read_typed_json
from ..sources.tables import load

# The four language codes of the documents and the label of the lookup.
LANGUAGES = ("en", "fr", "de", "es")
LANGUAGE_NAME = "English"
# Bronze status labels.
NEW, LOADED, QUARANTINED = "New", "Loaded", "Quarantined"

RUN_TS = dt.datetime(2024, 1, 15, 8, 30, 0)
MOVIES_PER_DOCUMENT = 2_000
BRONZE_DDL = "Movies STRING, record_key STRING, Ingesttime TIMESTAMP, p_Ingestdate DATE, Status STRING"
# Bronze folders: p_Ingestdate=<day>/Status=<status>. Reading the 'New' (or the
# 'Quarantined') rows prunes to those folders, so a run costs what arrived, not
# the whole history.
BRONZE_PARTITIONS = ["p_Ingestdate", "Status"]
LEDGER_DDL = "record_key STRING, p_prefix STRING"
LEDGER_DIGITS = 1  # 16 folders; two digits make 256 for a ledger of billions of records
QUARANTINE_PARTITION = "p_Ingestdate"
# Expected layer schemas, checked after each write.
SILVER_DDL = ("record_key STRING, Id BIGINT, Title STRING, Overview STRING, OriginalLanguage STRING, "
              "Price DOUBLE, ReleaseDate TIMESTAMP, Budget DOUBLE, Revenue DOUBLE, RunTime BIGINT, "
              "Tagline STRING, CreatedBy STRING, CreatedDate TIMESTAMP, UpdatedBy STRING, "
              "UpdatedDate TIMESTAMP, ImdbUrl STRING, TmdbUrl STRING, PosterUrl STRING, "
              "BackdropUrl STRING, p_ReleaseYear INT")
GENRE_DDL = "Genre_Id INT, Genre_Name STRING"
JUNCTION_DDL = "Movie_Id BIGINT, Genre_Id INT"
LANGUAGE_DDL = "Language_Code STRING, Language_Name STRING"
SILVER_COLUMNS = ["Id", "Title", "Overview", "OriginalLanguage", "Price", "ReleaseDate", "Budget",
                  "Revenue", "RunTime", "Tagline", "CreatedBy", "CreatedDate", "UpdatedBy",
                  "UpdatedDate", "ImdbUrl", "TmdbUrl", "PosterUrl", "BackdropUrl"]


# ------------------------------------------------------------------ raw documents
def movie_records(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    k = F.col("p_partkey")
    words = F.split(F.col("p_name"), " ")
    genres = F.transform(words, lambda w: F.struct(
        (F.ascii(w) * 1000 + F.ascii(F.substring(w, 2, 1))).cast("int").alias("id"), w.alias("name")))
    release = F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.date_format(F.date_add(ts_lit(dt.date(1990, 1, 1)), (k % 9000).cast("int")), "yyyy-MM-dd"),
                 F.lit("T00:00:00")))
    runtime = (F.when(k % 29 == 0, F.lit(None).cast("long"))
                .when(k % 31 == 0, F.lit(0).cast("long"))
                .when(k % 17 == 0, -F.col("p_size").cast("long"))
                .otherwise(F.col("p_size").cast("long")))
    lang = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (k % 4 + 1).cast("int"))
    rec = p.select(
        k.alias("Id"), F.col("p_name").alias("Title"), F.col("p_type").alias("Overview"),
        lang.alias("OriginalLanguage"), F.col("p_retailprice").alias("Price"),
        release.alias("ReleaseDate"), (F.col("p_size") * 1000.0).alias("Budget"),
        F.lit(None).cast("double").alias("Revenue"), runtime.alias("RunTime"),
        F.col("p_brand").alias("Tagline"), F.lit(None).cast("string").alias("CreatedBy"),
        F.lit(None).cast("string").alias("CreatedDate"), F.lit(None).cast("string").alias("UpdatedBy"),
        F.lit(None).cast("string").alias("UpdatedDate"),
        F.concat(F.lit("title/"), k.cast("string")).alias("ImdbUrl"),
        F.concat(F.lit("movie/"), k.cast("string")).alias("TmdbUrl"),
        F.lit(None).cast("string").alias("PosterUrl"), F.lit(None).cast("string").alias("BackdropUrl"),
        genres.alias("genres"))
    # every tenth movie arrives twice: a per-row copy count, expanded in place
    copies = F.when(F.col("Id") % 10 == 0, F.lit(2)).otherwise(F.lit(1))
    return rec.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")


def write_raw_documents(spark: SparkSession, sf: str, path: str,
                        per_document: int = MOVIES_PER_DOCUMENT, records: DataFrame | None = None) -> None:
    """One ``{"movie": [...]}`` document per file, at most ``per_document`` movies each
    (``records`` defaults to every movie derived from ``part``)."""
    rec = records if records is not None else movie_records(spark, sf)
    doc_no = F.floor(F.col("Id") / per_document)
    docs = (rec.select(doc_no.alias("doc_no"), F.struct(*rec.columns).alias("m"))
               .groupBy("doc_no")
               .agg(F.to_json(F.struct(F.collect_list("m").alias("movie"))).alias("value")))
    docs.repartition("doc_no").write.partitionBy("doc_no").text(path)


# ------------------------------------------------------------------ bronze
def stamp_ingest(raw: DataFrame, run_ts: dt.datetime | None = RUN_TS) -> DataFrame:
    """Ingestion metadata. ``run_ts=None`` stamps the current time; passing the run
    time keeps re-runs reproducible."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    day = ts.cast("date") if run_ts is None else ts_lit(run_ts.date())
    return raw.select(
        "Movies", F.sha2("Movies", 256).alias("record_key"),
        ts.alias("Ingesttime"), F.lit(NEW).alias("Status"), day.alias("p_Ingestdate"))


def create_bronze(spark: SparkSession, db: str) -> str:
    table = f"{db}.movies_bronze"
    create_partitioned_table(spark, table, BRONZE_DDL, ", ".join(BRONZE_PARTITIONS))
    return table


def create_ledger(spark: SparkSession, db: str) -> str:
    """Keys of all records ever delivered, partitioned by their first hex digits."""
    table = f"{db}.movies_ledger"
    create_partitioned_table(spark, table, LEDGER_DDL, "p_prefix")
    return table


def _with_prefix(keys: DataFrame) -> DataFrame:
    return keys.withColumn("p_prefix", F.substring("record_key", 1, LEDGER_DIGITS))


def raw_to_bronze(spark: SparkSession, raw_path: str, table: str, run_ts: dt.datetime = RUN_TS,
                  ledger: str | None = None) -> None:
    """Append the raw documents' records to bronze. With a ``ledger`` a record that an
    earlier delivery brought is not taken again (copies within one delivery are).

    Bronze is written before the ledger. What a failure in between left out of the
    ledger still has the status 'New', so those folders count as delivered, too, and
    the next run enters them. Only the ledger folders that the new keys fall into are read.
    """
    bronze = stamp_ingest(read_json_array(spark, raw_path, "movie", "STRING", "Movies"), run_ts)
    cols = spark.table(table).columns
    if ledger is None:
        # no shuffle on the ingest date: a whole run shares one value
        bronze.select(*cols).write.insertInto(table)
        return
    waiting = spark.table(table).filter(F.col("Status") == NEW).select("record_key")
    held = spark.table(ledger).select("p_prefix", "record_key")
    fresh = _with_prefix(bronze).join(held, ["p_prefix", "record_key"], "left_anti").join(waiting, "record_key", "left_anti")
    fresh.select(*cols).write.insertInto(table)
    enter_ledger(spark, table, ledger)


def enter_ledger(spark: SparkSession, bronze: str, ledger: str) -> None:
    """Enter the keys of bronze rows with status 'New' that the ledger does not hold."""
    keys = _with_prefix(spark.table(bronze).filter(F.col("Status") == NEW).select("record_key").distinct())
    held = spark.table(ledger).select("p_prefix", "record_key")
    keys.join(held, ["p_prefix", "record_key"], "left_anti").select(*spark.table(ledger).columns).write.insertInto(ledger)


# ------------------------------------------------------------------ silver
def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Typed movie columns from the raw text (PERMISSIVE: a bad field is null),
    the ingest date, and the release-year partition value; exact repeats are removed."""
    parsed = bronze.select("record_key", "p_Ingestdate", F.from_json("Movies", MOVIE).alias("m"))
    flat = parsed.select("record_key", "p_Ingestdate", "m.*")
    flat = flat.withColumn("p_ReleaseYear", F.year(F.col("ReleaseDate").cast("date")))
    return flat.dropDuplicates(["record_key"])


def quality_rule() -> Column:
    return F.col("Id").isNotNull() & F.col("ReleaseDate").isNotNull() & (F.col("RunTime") >= 0)


def clean_and_quarantine(parsed: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) silver rows; a null in the rule sends a row to quarantine
    (``strict`` keeps the two-filter behaviour where such rows land nowhere)."""
    return split_rows(parsed.drop("genres"), quality_rule(), strict=strict)


def genre_table(parsed: DataFrame) -> DataFrame:
    g = parsed.select(F.explode("genres").alias("g")).select(
        F.col("g.id").alias("Genre_Id"), F.col("g.name").alias("Genre_Name"))
    return dedup_keep_first(g, ["Genre_Id"], ["Genre_Name"])


def genre_table_by_name(parsed: DataFrame) -> DataFrame:
    """Genre lookup keyed by name with a generated key 1..n in name order (the
    pipeline variant: one row per distinct name, source ids ignored)."""
    names = parsed.select(F.explode("genres.name").alias("Genre_Name")).distinct()
    return add_surrogate_key(names, ["Genre_Name"], "Genre_Key")


def movie_genre_table(parsed: DataFrame) -> DataFrame:
    return (parsed.select(F.col("Id").alias("Movie_Id"), F.explode("genres").alias("g"))
                  .select("Movie_Id", F.col("g.id").alias("Genre_Id")).distinct())


def language_table(parsed: DataFrame) -> DataFrame:
    return (parsed.select(F.col("OriginalLanguage").alias("Language_Code")).distinct()
                  .withColumn("Language_Name", F.lit(LANGUAGE_NAME)))


def update_status(spark: SparkSession, table: str, updates: list[tuple[DataFrame, str]],
                  from_status: tuple[str, ...] = (NEW,)) -> None:
    """MERGE bronze USING keys ON record_key WHEN MATCHED UPDATE SET Status.

    ``updates`` pairs frames of record keys with the status they receive; all are
    applied in one merge. Matched rows can only be in ``from_status`` folders, so
    the ingest dates to touch come from that pruned scan; those dates' folders
    are rewritten (rows move between Status folders) and emptied folders dropped.
    """
    src = reduce(DataFrame.unionByName,
                 [k.select("record_key").withColumn("Status", F.lit(st)) for k, st in updates])
    src = src.dropDuplicates(["record_key"])
    bronze = spark.table(table)
    scope = bronze.filter(F.col("Status").isin(*from_status))
    touched = scope.join(src.select("record_key"), "record_key", "left_semi") \
                   .select("p_Ingestdate").distinct()
    part = bronze.join(F.broadcast(touched), "p_Ingestdate", "left_semi")  # one row for each day; a day is not one task's
    merged = merge_update(part, src, "record_key", {"Status": "Status"})
    apply_merge(spark, table, BRONZE_PARTITIONS, merged,
                affected=part.select(*BRONZE_PARTITIONS))


def repair_negative(df: DataFrame, col: str = "RunTime") -> DataFrame:
    return df.withColumn(col, F.abs(F.col(col)))


class MedallionRun:
    """The pipeline over one database. By default a fresh database and raw folder
    under the shared workspace; pass ``db`` / ``raw_path`` to run again over an
    existing one as new documents arrive (only the new bronze rows are parsed)."""

    def __init__(self, spark: SparkSession, sf: str, run_ts: dt.datetime | None = RUN_TS,
                 db: str | None = None, raw_path: str | None = None):
        self.spark, self.sf, self.run_ts = spark, sf, run_ts
        self.db = db or new_database(spark, "movies")
        self.root = new_run_dir(spark, "movies")
        self.raw_path = raw_path or f"{self.root}/raw"
        self._fresh_raw = raw_path is None  # a new run folder holds no documents yet
        self.bronze = create_bronze(spark, self.db)
        self.ledger = create_ledger(spark, self.db)
        self.silver = f"{self.db}.movies_silver"
        self.quarantine = f"{self.db}.movies_quarantine"

    def ingest(self, records: DataFrame | None = None) -> "MedallionRun":
        """Land raw documents (all movies derived from ``part`` unless ``records``
        are given) unless the raw folder already holds some, then load bronze."""
        if records is not None or self._fresh_raw or not self._raw_exists():
            write_raw_documents(self.spark, self.sf, self.raw_path, records=records)
        raw_to_bronze(self.spark, self.raw_path, self.bronze, self.run_ts, self.ledger)
        assert_schema(self.spark.table(self.bronze), parse_ddl(self.spark, BRONZE_DDL))
        return self

    def _raw_exists(self) -> bool:
        try:
            self.spark.read.text(self.raw_path).limit(1).count()
            return True
        except Exception:  # noqa: BLE001
            return False

    def parsed_new(self) -> DataFrame:
        return parse_bronze(self.spark.table(self.bronze).filter(F.col("Status") == NEW))

    def to_silver(self) -> "MedallionRun":
        parsed = self.parsed_new().checkpoint(eager=True)  # five sinks share one parse
        clean, bad = clean_and_quarantine(parsed)
        cols = SILVER_COLUMNS + ["p_ReleaseYear"]
        sinks = [
            lambda: _append(clean.select("record_key", *cols), self.silver, "p_ReleaseYear"),
            lambda: _append(bad.select("record_key", *cols, QUARANTINE_PARTITION), self.quarantine, QUARANTINE_PARTITION, moves=True),
            lambda: _upsert_lookup(genre_table(parsed), f"{self.db}.genres", ["Genre_Id"]),
            lambda: _append_unseen(movie_genre_table(parsed), f"{self.db}.movie_genres"),
            lambda: _upsert_lookup(language_table(parsed), f"{self.db}.languages", ["Language_Code"]),
        ]
        # independent sinks run as concurrent Spark jobs; any failure is raised here
        with ThreadPoolExecutor(max_workers=len(sinks)) as pool:
            for f in [pool.submit(s) for s in sinks]:
                f.result()
        assert_schema(self.spark.table(self.silver), parse_ddl(self.spark, SILVER_DDL))
        assert_schema(self.spark.table(f"{self.db}.genres"), parse_ddl(self.spark, GENRE_DDL))
        assert_schema(self.spark.table(f"{self.db}.movie_genres"), parse_ddl(self.spark, JUNCTION_DDL))
        assert_schema(self.spark.table(f"{self.db}.languages"), parse_ddl(self.spark, LANGUAGE_DDL))
        # statuses are set only after every sink has been written
        update_status(self.spark, self.bronze, [(clean, LOADED), (bad, QUARANTINED)])
        return self

    def repair(self) -> "MedallionRun":
        bad = parse_bronze(self.spark.table(self.bronze).filter(F.col("Status") == QUARANTINED))
        fixed, _still_bad = clean_and_quarantine(repair_negative(bad))
        fixed = fixed.checkpoint(eager=True)
        _append(fixed.select("record_key", *SILVER_COLUMNS, "p_ReleaseYear"), self.silver, "p_ReleaseYear")
        # only the ingest dates with repaired rows are written anew, beside the old files
        held = self.spark.table(self.quarantine)
        scope = held.join(F.broadcast(fixed.select(QUARANTINE_PARTITION).distinct()), QUARANTINE_PARTITION, "left_semi")
        left = scope.join(fixed.select("record_key"), "record_key", "left_anti").select(*held.columns)
        apply_merge(self.spark, self.quarantine, QUARANTINE_PARTITION, left, affected=scope)
        # the status comes last: a repair that failed before it is simply repeated
        update_status(self.spark, self.bronze, [(fixed, LOADED)], from_status=(QUARANTINED,))
        return self


def repair_by_action(run: MedallionRun) -> MedallionRun:
    """The repair as marked rows: each quarantined record is marked by what it asks of a
    table, and one pass over the touched partitions applies the marks. A repaired record
    that now passes the rule is inserted into silver and deleted from quarantine; any other
    is updated in quarantine."""
    spark = run.spark
    held = spark.table(run.quarantine)
    fixed = repair_negative(held).checkpoint(eager=True)  # read by both merges
    good = quality_rule()
    apply_actions_to(spark, run.silver, mark_rows(fixed.filter(good), F.lit(False)).drop(QUARANTINE_PARTITION), "record_key")
    apply_actions_to(spark, run.quarantine, mark_rows(fixed, good, when_true="delete", when_false="update"), "record_key")
    update_status(spark, run.bronze, [(fixed.filter(good), LOADED)], from_status=(QUARANTINED,))
    return run


def _append(df: DataFrame, table: str, partition_col: str | None = None, moves: bool = False) -> None:
    """Append the records that a table does not hold yet, creating it on the first run.
    A record keeps its partition value, so only the partitions that may hold it are read,
    unless it ``moves``: delivered again on another day."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        key = ["record_key"] + ([partition_col] if partition_col and not moves else [])
        new = df.join(spark.table(table).select(*key), key, "left_anti")
        new.select(*spark.table(table).columns).write.insertInto(table)
    elif partition_col:
        df.write.partitionBy(partition_col).saveAsTable(table)
    else:
        df.write.saveAsTable(table)


def _append_unseen(df: DataFrame, table: str) -> None:
    """Append the rows that a table does not hold yet (null-safe on all columns)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    held = spark.table(table)
    cond = reduce(Column.__and__, [df[c].eqNullSafe(held[c]) for c in held.columns])
    df.join(held, cond, "left_anti").select(*held.columns).write.insertInto(table)


def _upsert_lookup(df: DataFrame, table: str, key: list[str]) -> None:
    """Keyed upsert of a small lookup table (bounded by its domain: genres, languages):
    a new version is written whole, then the table's location switches to it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = merge_upsert(spark.table(table), df.select(*spark.table(table).columns), key)
    replace_table(df, table)


def _silver_view(df: DataFrame) -> DataFrame:
    # release time as wall-clock NTZ: the text carried no zone
    return df.select("Id", "Title", "OriginalLanguage", "Price",
                     F.col("ReleaseDate").cast("timestamp_ntz").alias("ReleaseDate"), "RunTime",
                     F.col("p_ReleaseYear").cast("int").alias("p_ReleaseYear"))


def m_bronze(spark, sf):
    run = MedallionRun(spark, sf).ingest()
    b = spark.table(run.bronze)
    return b.select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"),
                    F.get_json_object("Movies", "$.Title").alias("Title"), "Status", "p_Ingestdate")


def m_silver_clean(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return _silver_view(spark.table(run.silver))


def m_quarantine(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return _silver_view(spark.table(run.quarantine))


def m_genres(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return spark.table(f"{run.db}.genres")


def read_typed_movies(spark: SparkSession, raw_path: str) -> DataFrame:
    """Raw documents read with the fully typed nested schema (no raw text kept):
    one row per movie, typed columns straight from the reader."""
    docs = read_typed_json(spark, raw_path, StructType([StructField("movie", ArrayType(MOVIE))]))
    return docs.select(F.inline("movie"))


def unroll_genres(movies: DataFrame) -> DataFrame:
    """One row per (movie, genre) with mapped column names; movies without genres drop."""
    return map_columns(movies.select("Id", F.explode("genres").alias("g")),
                       [("Movie_Id", "Id"), ("Genre_Id", "g.id"), ("Genre_Name", "g.name")])


def m_unroll_genres(spark, sf):
    root = new_run_dir(spark, "movies_typed")
    write_raw_documents(spark, sf, f"{root}/raw")
    return unroll_genres(read_typed_movies(spark, f"{root}/raw"))


def m_genres_by_name(spark, sf):
    run = MedallionRun(spark, sf).ingest()
    return genre_table_by_name(run.parsed_new())


def m_junction(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return spark.table(f"{run.db}.movie_genres")


def m_languages(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return spark.table(f"{run.db}.languages")


def m_bronze_status(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver()
    return (spark.table(run.bronze)
            .select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"), "Status"))


def m_repaired(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver().repair()
    return _silver_view(spark.table(run.silver))


def m_repaired_status(spark, sf):
    run = MedallionRun(spark, sf).ingest().to_silver().repair()
    return (spark.table(run.bronze)
            .select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"), "Status"))


def m_repair_by_action(spark, sf):
    run = repair_by_action(MedallionRun(spark, sf).ingest().to_silver())
    layers = [_silver_view(spark.table(t)).withColumn("layer", F.lit(name)) for t, name in ((run.silver, "silver"), (run.quarantine, "quarantine"))]
    return layers[0].unionByName(layers[1])


def m_rerun(spark, sf):
    """Three deliveries: the later two bring part of the earlier documents again, under new
    names and on other days. Every record of bronze with its status and where it went."""
    run = MedallionRun(spark, sf)
    records = movie_records(spark, sf)
    deliveries = (F.col("Id") % 5 != 0, (F.col("Id") % 5 == 0) | (F.col("Id") % 3 == 0), F.lit(True))
    for day, part in enumerate(deliveries):
        path = f"{run.root}/delivery-{day}"
        write_raw_documents(spark, sf, path, records=records.filter(part))
        raw_to_bronze(spark, path, run.bronze, RUN_TS + dt.timedelta(days=day), run.ledger)
        run.to_silver()
    layers = [spark.table(t).select("record_key", F.lit(name).alias("layer")) for t, name in ((run.silver, "silver"), (run.quarantine, "quarantine"))]
    return (spark.table(run.bronze).join(layers[0].unionByName(layers[1]), "record_key", "left")
            .select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"), "Status", "layer"))
