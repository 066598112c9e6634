"""Readers, writers and the projection of the driver's tables into the record-linkage model.

Model: a clean table S1 and noisy tables S2 and S3 of (entity_id, business_name, business_address, country), all
strings, '' for missing; ground truth is one row per S1 id with a comma list of matched ids.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])


def _read(spark: SparkSession, path: str, schema: T.StructType, quoted: bool) -> DataFrame:
    head = spark.read.option("sep", "\t").option("quote", '"' if quoted else "").csv(path).limit(1).first()
    names = [] if head is None else list(head.asDict().values())
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    full = T.StructType([T.StructField(n or f"_{i}", T.StringType()) for i, n in enumerate(names)])
    df = (
        spark.read.schema(full)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", '"' if quoted else "")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("lineSep", "\n")
        .csv(path)
    )
    return df.select(*(F.coalesce(F.col(f.name), F.lit("")).alias(f.name) for f in schema))


def read_source(spark: SparkSession, path: str, quoted: bool = True) -> DataFrame:
    """A source table; short rows are padded with ''; other columns are dropped."""
    return _read(spark, path, SOURCE, quoted)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TRUTH, True)


def read_lines(spark: SparkSession, path: str, least: int = 4) -> DataFrame:
    """Raw lines split at tabs without quoting; shorter rows and the head line are skipped."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).select(cells.alias("c")).where(F.size("c") >= least)
    rows = rows.select(*(F.col("c")[i].alias(f.name) for i, f in enumerate(SOURCE)))
    return rows.where("entity_id <> 'entity_id'")


def parse_ids(column: str):
    """A comma list as an array, without empty cells; '' gives an empty array."""
    return F.filter(F.transform(F.split(F.trim(F.coalesce(F.col(column), F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x != "")


def truth_pairs(truth: DataFrame) -> DataFrame:
    """One row per true pair; a null match for an entity without any."""
    return truth.select("source1_entity_id", F.explode_outer(parse_ids("matched_entity_ids")).alias("matched_entity_id"))


def id_lists(rows: DataFrame, id_col: str, list_col: str) -> DataFrame:
    """Id lists as text: comma-joined, repeats dropped, order kept."""
    return rows.select(id_col, F.array_join(F.array_distinct(list_col), ",").alias(list_col))


def write_id_lists(rows: DataFrame, path: str, id_col: str, list_col: str) -> None:
    """Writes id lists as a tab-separated table with a head line and no quoting."""
    id_lists(rows, id_col, list_col).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option(
        "escape", "\\"
    ).option("emptyValue", "").csv(path)


def write_matching_results(rows: DataFrame, path: str) -> None:
    write_id_lists(rows, path, "source1_entity_id", "matched_entity_ids")


def write_candidate_pairs(rows: DataFrame, path: str) -> None:
    write_id_lists(rows, path, "source1_entity_id", "candidate_entity_ids")


def write_candidates(candidates: DataFrame, path: str) -> None:
    """The candidate table as Parquet, a folder per country if it has one."""
    writer = candidates.write.mode("overwrite")
    (writer.partitionBy("country") if "country" in candidates.columns else writer).parquet(path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """The candidate table that ``write_candidates`` wrote."""
    return spark.read.parquet(path)


def write_source(rows: DataFrame, path: str) -> None:
    """A source table, tab-separated and quoted, with a head line."""
    rows.select(*(f.name for f in SOURCE)).write.mode("overwrite").options(
        sep="\t", header=True, quote='"', escape='"', quoteAll=True, emptyValue="", lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_table(rows: DataFrame, path: str) -> None:
    """A result table as CSV with a head line."""
    rows.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_config(spark: SparkSession, path: str, config: dict) -> None:
    import json

    spark.range(1).select(F.lit(json.dumps(config)).alias("value")).write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str, defaults: dict) -> dict:
    import json

    return defaults | json.loads(spark.read.text(path).first()[0])


def markdown(rows: DataFrame) -> DataFrame:
    """Rows as lines of a Markdown table; pipes inside cells become slashes."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("/")) for c in rows.columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- files of the session ------------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``; only a local session may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file:///tmp/checkpoints/tessera"
    return found.rstrip("/")


_CACHED: dict[tuple, str] = {}


def cached(spark: SparkSession, name: str, build: Callable[[], DataFrame], *keys) -> DataFrame:
    """The frame that ``build`` makes, as Parquet in the shared folder: written once a session for each name and keys.

    A key holds the paths, sizes and times of the input files, so changed files are read anew.  Lost files are, too.
    """
    key = (spark.sparkContext.applicationId, name, *map(str, keys))
    if kept(spark, name, *keys) is None:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _CACHED[key] = path
        # Shuffle files stay until the driver collects its garbage; the ones of this write serve nobody now.
        gc.collect()
        spark._jvm.System.gc()
    return spark.read.parquet(_CACHED[key])


def kept(spark: SparkSession, name: str, *keys) -> DataFrame | None:
    """The frame that ``cached`` has written in this session, if it has."""
    path = _CACHED.get((spark.sparkContext.applicationId, name, *map(str, keys)))
    return spark.read.parquet(path) if path and _exists(spark, f"{path}/_SUCCESS") else None


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(found)


def stamp(spark: SparkSession, path: str) -> str:
    """Sizes and times of the files under a path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(found)
    return f"{path}:" + ",".join(sorted(f"{f.getPath().getName()}/{f.getLen()}/{f.getModificationTime()}" for f in files))


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as the session runs tasks at once: a small file is one partition."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= wanted else df.repartition(wanted)


# --- projection of `documents` -------------------------------------------------------------------------------
# The first sentence of a document is its name and all that follows its address; the language gives
# the country and the source one of three tables.  Written records follow, which hold what prose does not: prefixes,
# domains, legal suffixes, landmarks, abbreviations, postal codes, other scripts and missing fields.

LITERALS = [
    ("S1-L01", "Pioneer Industries Private Limited", "Near SBI ATM, MG Rd, No. 5", "India"),
    ("S2-L01", "Pioneer Industries Private Limited", "Near SBI ATM, MG Road, Number 5, Pune 411001", "India"),
    ("S1-L02", "M/s. Foo Traders Pvt. Ltd.", "opp. Bus Stand, nr Temple, Pune 411001", "India"),
    ("S3-L02", "Foo Traders Pvt Ltd", "Opposite Bus Stand, Temple Road, Pune 411001", "India"),
    ("S1-L03", "energyvrtextile.com", "Plot 42, Sec 18, 42", "India"),
    ("S2-L03", "EnergyVR Textile", "Plot 42, Sector 18", "India"),
    ("S1-L04", "AT&T Inc", "151 W 25th St, Ste 4, Springfield, IL 62704", "US"),
    ("S2-L04", "AT&T Inc", "151 West 25th Street, Suite 4, Springfield 62704", "US"),
    ("S1-L05", "Boulangerie St. Honoré SARL", "12 Rue St-Honoré, 75008 Paris", "France"),
    ("S2-L05", "Boulangerie St. Honoré SARL", "5 Av. de la République, 75008 Paris", "France"),
    ("S3-L05", "Boulangerie Saint Honore", "12 rue Saint-Honoré 75008 Paris", "France"),
    ("S1-L06", "St. Jude Supplies", "12345 Elm St, Springfield, IL 62704", "US"),
    ("S3-L06", "St. Jude Supplies", "12345 Elm St", "US"),
    ("S1-L07", "-- Mr. Smith & Sons LLC", "Next to Park Ave", "US"),
    ("S2-L07", "Smith & Sons", "beside Park Ave Blvd Apt 3 Fl 2 62704-1234", "US"),
    ("S1-L08", "Acme.co.in", "behind City Mall, Hwy 7, Nagpur 440001", "India"),
    ("S2-L08", "ACME", "adjacent to City Mall, Highway 7, Nagpur 440001", "India"),
    ("S1-L09", "北京贸易 Traders", "长安街 12, 110001", "India"),
    ("S2-L09", "北京贸易 Traders", "Chang An Road 12, 110001", "India"),
    ("S1-L10", "Foo Co Ltd Pvt Inc LLC", "10 Hill Ln, Dallas 75201", "US"),
    ("S3-L10", "Foo Company Limited", "10 Hill Lane, Dallas 75201", "US"),
    ("S1-L11", "Smith Associates Group", "5 Lake Dr", "US"),
    ("S2-L11", "Smith Associates", "5 Lake Drive", "US"),
    ("S1-L12", "Co Op Market Inc.", "9 Rue Cler, 69002 Lyon", "France"),
    ("S2-L12", "Co Op Market", "9 rue Cler, 69002 Lyon", "France"),
    ("S2-L16", "Co Op Market Inc.", "1 Main St, Boston 02108", "US"),
    ("S1-L13", "Ltd", "", "US"),
    ("S2-L13", "Ltd", "", "US"),
    ("S1-L14", "Sharma Foods Pvt Ltd", "H.No. 12, Opp. Rly Station, Jaipur 302001", "India"),
    ("S3-L14", "Sharma Foods Private Limited", "House No 12, Opposite Railway Station, Jaipur 302001", "India"),
    ("S1-L15", "dba Blue Sky Café SAS", "75 Bd Voltaire, 75011 Paris", "France"),
    ("S2-L15", "Blue Sky Cafe", "75 Boulevard Voltaire 75011 Paris", "France"),
    ("S3-L15", "Café Sky Blue SAS", "75 Bd Voltaire, 75011 Paris", "France"),
]


def literal_records(spark: SparkSession) -> DataFrame:
    names = [f.name for f in SOURCE]
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in LITERALS))
    return spark.range(1).select(F.inline(rows))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    name = F.regexp_extract(F.coalesce("text", F.lit("")), r"^[^.!?\n]*", 0)
    rest = F.regexp_replace(F.substr("text", F.length(name) + 1, F.length("text")), r"^[.!?\s]+", "")
    number = F.expr("try_cast(substr(source, 4) as int)")
    country = F.expr("case lang when 'en' then 'US' when 'fr' then 'France' when 'es' then 'India' when 'de' then 'Germany' else lang end")
    rows = docs.select(
        F.concat(F.lit("S"), (number % 3 + 1).cast("string"), F.lit("-"), F.expr("lpad(string(doc_id), greatest(12, length(string(doc_id))), '0')")).alias("entity_id"),
        name.alias("business_name"),
        F.coalesce(F.replace(rest, F.lit("\n"), F.lit(" ")), F.lit("")).alias("business_address"),
        country.alias("country"),
    )
    return rows.unionByName(literal_records(spark))


def of_source(ents: DataFrame, *tags: str) -> DataFrame:
    return ents.where(F.split_part("entity_id", F.lit("-"), F.lit(1)).isin(*tags))


def truth(ents: DataFrame, every: bool = False) -> DataFrame:
    """True pairs: noisy records that share country and name with an S1 record go to the smallest such id, or to ``every`` one."""
    tagged = ents.select("entity_id", "country", "business_name")
    own = of_source(tagged, "S1")
    if every:
        own = own.withColumnRenamed("entity_id", "source1_entity_id")
    else:
        own = own.groupBy("country", "business_name").agg(F.min("entity_id").alias("source1_entity_id"))
    noisy = of_source(tagged, "S2", "S3").withColumnRenamed("entity_id", "matched_entity_id")
    hits = own.join(noisy, ["country", "business_name"]).select("source1_entity_id", "matched_entity_id")
    ids = of_source(tagged, "S1").select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(hits, "source1_entity_id", "left")


_VALUES = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in LITERALS)
ENTITIES_SQL = r"""ent as (
  select 'S' || (1 + substr(source, 4)::INT % 3)::VARCHAR || '-' || lpad(doc_id::VARCHAR, greatest(12, length(doc_id::VARCHAR))::INT, '0') as entity_id,
    regexp_extract(text, '^[^.!?\n]*') as business_name,
    replace(regexp_replace(substr(text, length(regexp_extract(text, '^[^.!?\n]*')) + 1), '^[.!?\s]+', ''), chr(10), ' ') as business_address,
    case lang when 'en' then 'US' when 'fr' then 'France' when 'es' then 'India' when 'de' then 'Germany' else lang end as country
  from documents
  union all select * from (values """ + _VALUES + """) as v(entity_id, business_name, business_address, country))"""

TRUTH_SQL = """gt as (
  select s.entity_id as source1_entity_id, n.entity_id as matched_entity_id
  from ent s
  left join (select country, business_name, min(entity_id) as s1 from ent where entity_id like 'S1-%' group by all) o on o.s1 = s.entity_id
  left join ent n on n.entity_id not like 'S1-%' and n.country = o.country and n.business_name = o.business_name
  where s.entity_id like 'S1-%')"""
