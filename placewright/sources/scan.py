"""Reading listings, features and registers from landed files, always with declared schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo, shapes, text
from ..operators.evidence import EVIDENCE
from .register_text import RegisterText

# Fixed values of the map features' tags.
MAIN_KEYS = ("amenity", "shop", "tourism", "leisure", "office", "craft", "healthcare", "historic")
DEAD_PREFIXES = ("disused", "was", "abandoned", "closed")
DULL = "parking parking_space parking_entrance bench bicycle_parking bicycle_rental bus_stop waste_basket toilets drinking_water shelter post_box telephone vending_machine recycling pitch swimming_pool playground picnic_table information yes no"


def scan_box_parquet(spark: SparkSession, path: str, box: tuple[float, float, float, float], country: str | None = None) -> DataFrame:
    """Named rows of a parquet table in a box; the comparisons reach the row groups' statistics."""
    df = spark.read.parquet(path)
    df = df.where(F.col("name").isNotNull() & geo.in_box(F.col("lat"), F.col("lng"), box))
    return df if country is None else df.where(F.col("country") == country)


def flatten_base(df: DataFrame) -> DataFrame:
    """Nested listings to flat rows: struct fields, first or matching array elements, distinct datasets."""
    first = lambda c: F.get(c, F.lit(0))
    wiki = lambda x: x.rlike("^Q[0-9]+$")
    return df.select(
        "id", F.col("names.primary").alias("name"), F.col("taxonomy.primary").alias("category"), F.col("taxonomy.hierarchy")[0].alias("category_group"),
        F.col("brand.names.primary").alias("brand"), F.when(wiki(F.col("brand.wikidata")), F.col("brand.wikidata")).alias("brand_wikidata"),
        first(F.col("addresses"))["freeform"].alias("address"), first(F.col("addresses"))["locality"].alias("city"), first(F.col("addresses"))["region"].alias("region"), first(F.col("addresses"))["postcode"].alias("postcode"),
        first(F.col("phones")).alias("phone"), first(F.col("websites")).alias("website"), "confidence", "operating_status",
        first(F.filter("sources", lambda s: F.lower(s["dataset"]) == "foursquare"))["record_id"].alias("fsq_id"),
        F.array_distinct(F.transform("sources", lambda s: s["dataset"])).alias("datasets"), F.col("bbox.ymin").alias("lat"), F.col("bbox.xmin").alias("lng"),
    )


def parse_chain_features(lines: DataFrame, box: tuple[float, float, float, float], country: str | None = None) -> DataFrame:
    """Chain listings from one GeoJSON feature a line; lines outside the box go before any parsing."""
    spot = r'"coordinates" *: *\[ *(-?[0-9.]+) *, *(-?[0-9.]+)'
    num = lambda g: F.regexp_extract("value", spot, g).try_cast("double")
    rows = lines.withColumns({"lng": num(1), "lat": num(2)}).where(geo.in_box(F.col("lat"), F.col("lng"), box))
    rows = rows.withColumn("p", F.from_json("value", "properties map<string,string>, id string"))
    p = lambda *ks: F.coalesce(*[text.null_if_empty(F.element_at("p.properties", k)) for k in ks])
    category = F.coalesce(*[F.concat(F.lit(f"{k}="), F.element_at("p.properties", k)) for k in MAIN_KEYS])
    ref = F.coalesce(p("ref"), F.concat_ws(",", F.col("lat").cast("string"), F.col("lng").cast("string")))
    out = rows.select(
        F.concat_ws("/", p("@spider"), ref).alias("atp_id"), p("@spider").alias("spider"), p("ref").alias("ref"), p("name", "brand").alias("name"), p("branch").alias("branch"), p("brand").alias("brand"),
        p("brand:wikidata").alias("brand_wikidata"), category.alias("category"), F.coalesce(p("addr:street_address", "addr:full"), text.null_if_empty(F.concat_ws(" ", p("addr:housenumber"), p("addr:street")))).alias("address"),
        p("addr:housenumber").alias("housenumber"), p("addr:city").alias("city"), p("addr:state").alias("region"), p("addr:postcode").alias("postcode"), p("phone").alias("phone"), p("website").alias("website"),
        p("opening_hours").alias("opening_hours"), p("end_date").alias("end_date"), p("addr:country").alias("country"), "lat", "lng",
    ).where("name is not null")
    out = out if country is None else out.where((F.col("country") == country) | F.col("country").isNull())
    return out.drop("country")


def classify_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Features with category, lifecycle and name: the first live main key, or a dead one behind a lifecycle prefix (in
    key order, prefixes first). Dull values and nameless features go."""
    t = lambda k: F.element_at(tags, k)
    live = F.coalesce(*[F.when(t(k).isNotNull(), F.struct(F.lit(k).alias("key"), t(k).alias("value"), F.lit(None).cast("string").alias("prefix"))) for k in MAIN_KEYS])
    dead = F.coalesce(*[F.when(t(f"{x}:{k}").isNotNull(), F.struct(F.lit(k).alias("key"), t(f"{x}:{k}").alias("value"), F.lit(x).alias("prefix"))) for x in DEAD_PREFIXES for k in MAIN_KEYS])
    out = df.withColumn("_k", F.coalesce(live, dead)).where("_k is not null")
    old = F.coalesce(*[F.when(F.col("_k.prefix") == x, t(f"{x}:name")) for x in DEAD_PREFIXES], t("old_name"))
    name = F.coalesce(t("name"), F.when(F.col("_k.prefix").isNotNull(), old))
    out = out.withColumns({"name": name, "category": F.concat_ws("=", "_k.key", "_k.value"), "lifecycle": F.col("_k.prefix")})
    return out.where(F.col("name").isNotNull() & ~F.col("_k.value").isin(*DULL.split())).drop("_k")


def project_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    """The flat attribute columns of features, with second keys where the first is missing."""
    t = lambda *ks: F.coalesce(*[F.element_at(tags, k) for k in ks])
    cols = {
        "housenumber": t("addr:housenumber"), "street": t("addr:street"), "city": t("addr:city"), "region": t("addr:state"), "postcode": t("addr:postcode"), "phone": t("phone", "contact:phone"),
        "website": t("website", "contact:website"), "opening_hours": t("opening_hours"), "brand": t("brand"), "brand_wikidata": t("brand:wikidata"), "wikidata": t("wikidata"),
        "check_date": t("check_date", "survey:date"), "end_date": t("end_date"), "siret": t("ref:FR:SIRET"),
    }
    return df.withColumns(cols)


FEATURES = "osm_id string, edited long, name string, category string, lifecycle string, geometry string"


def newest_edit(df: DataFrame) -> DataFrame:
    w = W.partitionBy("osm_id").orderBy(F.desc("edited"), "name", "category")
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def scan_features(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, schema: str = FEATURES) -> DataFrame:
    """Line-JSON features with declared columns, ``geometry`` as GeoJSON: epoch seconds to a date, the geometry's centroid
    as lng and lat, the box, the newest edit an id. Features whose geometry cannot be read have no position; a box drops them."""
    df = spark.read.schema(schema).json(path)
    df = shapes.with_centroid(df).drop("geometry")
    df = df if box is None else df.where(geo.in_box(F.col("lat"), F.col("lng"), box))
    return newest_edit(df).withColumn("edited", F.to_date(F.timestamp_seconds("edited")))


def scan_evidence(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(EVIDENCE).csv(paths, header=True, quote='"', escape='"', multiLine=False)


def union_evidence(spark: SparkSession, *dfs: DataFrame) -> DataFrame:
    """The union over a typed empty relation; columns beyond the eight are left out, missing ones are null."""
    from ..operators.publish import ensure_columns

    out = spark.createDataFrame([], EVIDENCE)
    for df in dfs:
        out = out.unionByName(ensure_columns(df, out.schema).select(*[F.col(f.name).cast(f.dataType) for f in out.schema.fields]))
    return out


def optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one of the schema if nothing is there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_snapshot(spark: SparkSession, glob: str, pattern: str = r"status-([^/]+?)\.parquet") -> DataFrame:
    """Many status files, the region taken from each file's name (or its folder's)."""
    df = spark.read.option("recursiveFileLookup", True).parquet(glob)
    return df.withColumn("region", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def scan_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, mode="PERMISSIVE", quote='"', escape='"')


def dedupe_exact(df: DataFrame, keys: tuple[str, ...] = ("spider", "ref", "lat", "lng")) -> DataFrame:
    return df.dropDuplicates(list(keys))


@dataclass
class FileSpec:
    """How a register's text file is laid out."""

    columns: list[str] = field(default_factory=list)
    sep: str = ","
    quote: str = '"'
    encoding: str = "UTF-8"
    header: bool = True
    trim: bool = False
    skip_until: str | None = None


def scan_register_text(spark: SparkSession, path: str, spec: FileSpec) -> DataFrame:
    """A delimited register, all columns strings. ``columns`` names them in order where the file has no header;
    ``skip_until`` is a pattern of the header line behind a preamble, which every file then has for itself: such files are
    read by ``register_text``, with its columns about file, offset, surplus fields and preamble."""
    if spec.skip_until:
        spark.dataSource.register(RegisterText)
        reader = spark.read.format("register_text").options(path=path, sep=spec.sep, quote=spec.quote, encoding=spec.encoding, trim=str(spec.trim), skip_until=spec.skip_until)
        return (reader.option("columns", "\n".join(spec.columns)) if spec.columns else reader).load()
    options = dict(sep=spec.sep, quote=spec.quote, escape=spec.quote, encoding=spec.encoding, ignoreLeadingWhiteSpace=spec.trim, ignoreTrailingWhiteSpace=spec.trim, mode="PERMISSIVE")
    df = spark.read.csv(path, header=spec.header, **options)
    return df.toDF(*spec.columns, *df.columns[len(spec.columns) :]) if spec.columns else df


def explode_pages(df: DataFrame, schema: str, rows: Column, value: str = "value") -> DataFrame:
    """Landed JSON pages to their rows: parse by schema, explode, flatten."""
    return df.select(F.from_json(value, schema).alias("page")).select(F.explode(rows).alias("r")).select("r.*")


def point_of(c: Column, part: str) -> Column:
    """'lat' or 'lng' of a text '(lat, lng)' or of GeoJSON point coordinates; zero is missing."""
    pair = r"\( *(-?[0-9.]+) *, *(-?[0-9.]+) *\)"
    json = r'"coordinates" *: *\[ *(-?[0-9.]+) *, *(-?[0-9.]+)'
    a, b = (1, 2) if part == "lat" else (2, 1)
    v = F.coalesce(F.regexp_extract(c, pair, a).try_cast("double"), F.regexp_extract(c, json, b).try_cast("double"))
    return F.when(v != 0, v)


def extract_html_rows(pages: DataFrame, row: str, cell: str, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, row, cells): the matches of ``row`` in each landed page, and the ``cell`` matches in each, without tags and
    with the basic character references decoded."""
    out = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(row), F.lit(1))).alias("row", "_r"))
    plain = lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", ""))

    def decode(x: Column) -> Column:
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    cells = F.transform(F.regexp_extract_all("_r", F.lit(cell), F.lit(1)), lambda x: decode(plain(x)))
    return out.select(*keep, "row", cells.alias("cells"))


def as_of(kind: str, c: Column) -> Column:
    """The day a list speaks for: 'month_end' of a date, 'school_year' (June 30 of a '2023-24' year), 'file_tag' (the
    first yyyymmdd of a name), 'month_in_url' (yyyy/mm or yyyy-mm, its first day)."""
    return {
        "month_end": lambda: F.last_day(c),
        "school_year": lambda: F.make_date(F.regexp_extract(c, "([0-9]{4})", 1).try_cast("int") + 1, F.lit(6), F.lit(30)),
        "file_tag": lambda: F.to_date(F.try_to_timestamp(F.regexp_extract(c, "([0-9]{8})", 1), F.lit("yyyyMMdd"))),
        "month_in_url": lambda: F.make_date(F.regexp_extract(c, "(20[0-9]{2})[-/]([0-9]{2})", 1).try_cast("int"), F.regexp_extract(c, "(20[0-9]{2})[-/]([0-9]{2})", 2).try_cast("int"), F.lit(1)),
    }[kind]()


def establishments(est: DataFrame, units: DataFrame) -> DataFrame:
    """Establishments with a public name: the sign, else the usual name, else the company's unless it is a natural
    person; those without name, date or position go. Only the companies that have an establishment are read on."""
    used = units.join(est.select("siren"), "siren", "left_semi")
    out = est.join(used, "siren", "left")
    company = F.when(~F.coalesce(F.col("natural_person"), F.lit(False)), F.col("company"))
    name = F.coalesce(text.null_if_empty(F.trim("sign")), text.null_if_empty(F.trim("usual_name")), text.null_if_empty(F.trim(company)))
    return out.withColumn("name", name).where("name is not null and day is not null and x is not null and y is not null")


def drop_non_places(df: DataFrame, deny: tuple[str, ...], category: str = "category") -> DataFrame:
    return df.where(~F.coalesce(F.col(category), F.lit("")).isin(*deny))
