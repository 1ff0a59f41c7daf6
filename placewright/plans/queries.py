"""The registered queries of the place domain, with the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categories, geo, shapes, similarity, text
from ..operators import canon, evidence, groups, match, mint, monitor, outline, publish, registers, report, score
from ..sources import register_specs, scan
from ..sources.store import settled, shared_folder
from . import build, fixtures
from . import sqltext as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BUILD = fixtures.BUILD
STOREFRONTS = {"reg_front": "bank", "reg_list": "restaurant", "abca_dc_active": "licensed_premises"}
LISTS = {"DC": "reg_front", "NY": "reg_list"}


class Data:
    """The inputs of a query: tables of a folder, and the place views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, select: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, select)

    def base(self) -> DataFrame:
        return build.addressed(build.named(self.view("select * from fx_base")))

    def chain(self) -> DataFrame:
        return build.named(self.view("select * from fx_chain"), "housenumber")

    def register(self) -> DataFrame:
        rows = self.view("select * from fx_register")
        return build.keyed_register(registers.first_rows(rows, [F.col("source"), F.col("source_id")], [F.desc("date"), "state", "name", "address"]))

    def evidence(self) -> DataFrame:
        return self.view("select * from fx_evidence")

    def snap(self, half: str) -> DataFrame:
        return self.view(f"select id, status from fx_snap where half = '{half}'")

    def pairs(self) -> DataFrame:
        return match.match_pairs(self.base(), self.chain())

    def status(self) -> DataFrame:
        return evidence.status_of(self.evidence(), BUILD)

    def folder(self) -> str:
        """A new folder under the shared one, for queries that write and read back."""
        return f"{shared_folder(self.spark)}/placewright-{uuid.uuid4().hex}"


def q(key: str, sql: str | None = None):
    def register(f: Callable[[Data], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: f(Data(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


def expr(key: str, view: str, columns: Callable[[], dict], sql: dict[str, str], table: str | None = None) -> None:
    """A query of expressions over a view (or a table)."""
    source = table or view
    run = lambda d: (d.table(table) if table else d.view(f"select * from {view}")).select(*[c.alias(n) for n, c in columns().items()])
    cols = ", ".join(f"{s} as {n}" for n, s in sql.items())
    q(key, f"select {cols} from {table}" if table else Q.query(f"select {cols} from {source}"))(run)


c = F.col

# --- functions ---------------------------------------------------------------------------------------------------
expr("fn_01_strip_accents", "", lambda: {"doc_id": c("doc_id"), "plain": text.strip_accents(c("text"))}, {"doc_id": "doc_id", "plain": "strip_accents(text)"}, table="documents")
expr("fn_02_clean_name", "", lambda: {"doc_id": c("doc_id"), "clean": text.clean_name(c("text"))}, {"doc_id": "doc_id", "clean": Q.clean("text")}, table="documents")
expr("fn_03_norm_name", "fx_base", lambda: {"id": c("id"), "nn": text.norm_name(c("name"))}, {"id": "id", "nn": Q.norm("name")})
expr("fn_04_house_number", "fx_register", lambda: {"source_id": c("source_id"), "hn": text.house_number(c("address"))}, {"source_id": "source_id", "hn": Q.house("address")})
expr("fn_09_zip5", "fx_register", lambda: {"source_id": c("source_id"), "zip": text.zip5(c("address"))}, {"source_id": "source_id", "zip": Q.zip5("address")})
expr("fn_10_street_key", "fx_register", lambda: {"source_id": c("source_id"), "sk": text.street_key(c("address"))}, {"source_id": "source_id", "sk": Q.street("address")})
# Kinds and, from the published vocabulary, their group, subgroup, bucket, and whether they need a licence to
# sell alcohol, written out here to be held against the library's rules.
_EXPECTED = [
    ("bar", None, None, "bars", True),
    ("amenity=pub", "food_and_drink", "alcoholic_beverage_venue", "bars", True),
    ("restaurant", "food_and_drink", "restaurant", "restaurants and cafes", False),
    ("shop=books", "shopping", "specialty_store", "everything else", False),
    ("office=lawyer", "services_and_business", None, "everything else", False),
    ("leisure=park", "sports_and_recreation", "park", "parks", False),
    ("craft=winery", "food_and_drink", "alcoholic_beverage_venue", "everything else", False),
    ("shop=florist", "shopping", "specialty_store", "everything else", False),
    ("historic=castle", "cultural_and_historic", "historic_site", "everything else", False),
    ("tourism=hotel", "lodging", "hotel", "hotels", False),
    ("amenity=atm", "services_and_business", "financial_service", "everything else", False),
    ("bank", "services_and_business", "financial_service", "banks and credit unions", False),
    ("shop=hairdresser", "lifestyle_services", "personal_or_beauty_service", "everything else", False),
    ("fast_food_restaurant", None, None, "fast food", False),
    ("art_museum", None, None, "museums", False),
    ("high_school", None, None, "schools", False),
    ("ev_charging_station", None, None, "ev chargers", False),
    ("amenity=cafe", "food_and_drink", "non_alcoholic_beverage_venue", "restaurants and cafes", False),
    ("pharmacy", None, None, "pharmacies", False),
    ("unknown_kind", None, None, "everything else", False),
    ("night_club", None, None, "bars", True),
]
_CATS = [x[0] for x in _EXPECTED]
_PICKED = lambda i, values: f"(array[{', '.join('null' if v is None else repr(v) for v in values)}])[cast({i} % {len(values)} as int) + 1]"
_CAT_SPARK = lambda: F.get(F.array(*[F.lit(x) for x in _CATS]), (c("p_partkey") % len(_CATS)).cast("int"))
expr("fn_11_needs_alcohol_license", "", lambda: {"p_partkey": c("p_partkey"), "needs": categories.needs_alcohol_license(_CAT_SPARK())}, {"p_partkey": "p_partkey", "needs": _PICKED("p_partkey", [x[4] for x in _EXPECTED])}, table="part")
expr("fn_12_title_case", "fx_register", lambda: {"source_id": c("source_id"), "shown": text.title_case(c("name"))}, {"source_id": "source_id", "shown": Q.title("name")})
expr("fn_13_display_name", "fx_register", lambda: {"source_id": c("source_id"), "shown": text.display_name(F.concat(c("name"), F.lit(" STORE #12")))}, {"source_id": "source_id", "shown": Q.display("(name || ' STORE #12')")})
expr("fn_14_address_parts", "fx_register", lambda: {"source_id": c("source_id"), "street": text.address_street(c("address")), "city": text.address_city(c("address")), "region": text.address_state(c("address"))},
     {"source_id": "source_id", "street": Q.title("split_part(address, ', ', 1)"), "city": f"nullif({Q.title("split_part(address, ', ', 2)")}, '')", "region": "nullif(regexp_extract(address, ', ([A-Z]{2}) [0-9]{5}', 1), '')"})
expr("fn_15_join_address", "fx_base", lambda: {"id": c("id"), "joined": text.join_address(c("address"), c("brand"), F.lit(" "), c("region"))}, {"id": "id", "joined": "concat_ws(', ', nullif(trim(address), ''), nullif(trim(brand), ''), nullif(trim(region), ''))"})
_SC = lambda: F.concat(c("address"), F.lit(" Falls Church, VA "), c("postcode"))
_SC_SQL = "(address || ' Falls Church, VA ' || postcode)"
_SC_RE = f"(?i)^(.*\\b(?:{text.STREET_WORDS})\\b\\.?) +([a-z .]+), *([a-z]{{2}}) +([0-9]{{5}})"
expr("fn_16_street_city", "fx_base", lambda: {"id": c("id"), **{p: text.street_city(_SC(), p) for p in ("street", "city", "state", "zip")}}, {"id": "id", **{p: f"nullif(trim(regexp_extract({_SC_SQL}, '{_SC_RE}', {i})), '')" for i, p in enumerate(("street", "city", "state", "zip"), 1)}})
_D = lambda: F.to_date("o_orderdate")
_FORMS = lambda: [F.date_format(_D(), "M/d/yyyy"), F.date_format(_D(), "MM-dd-yyyy"), F.date_format(_D(), "d MMMM yyyy"), F.date_format(_D(), "yyyy-MM-dd"), F.date_format(_D(), "yyyyMM"), F.datediff(_D(), F.lit("1899-12-30").cast("date")).cast("string"), (F.unix_date(_D()).cast("long") * 86_400_000 + 5_000).cast("string"), F.lit("n/a")]
expr("fn_17_parse_dates", "", lambda: {"o_orderkey": c("o_orderkey"), "day": text.parse_date(F.get(F.array(*_FORMS()), (c("o_orderkey") % 8).cast("int")))},
     {"o_orderkey": "o_orderkey", "day": "case o_orderkey % 8 when 4 then cast(date_trunc('month', o_orderdate) as date) when 7 then null else cast(o_orderdate as date) end"}, table="orders")
expr("fn_18_trade_name", "fx_base", lambda: {"id": c("id"), "behind": text.trade_name(F.concat(F.lit("HOLDING LTD DBA "), c("name"))), "column": text.trade_name(c("name"), c("brand")), "added": text.trade_name(c("name"), None, " Credit Union")},
     {"id": "id", "behind": "trim(name)", "\"column\"": "coalesce(nullif(trim(brand), ''), trim(name))", "added": "trim(name) || ' Credit Union'"})
expr("fn_19_surrogate_id", "fx_register", lambda: {"source_id": c("source_id"), "sid": text.surrogate_id(c("name"), c("address"))}, {"source_id": "source_id", "sid": "substr(sha1(upper(concat_ws('|', name, address))), 1, 16)"})
# Sources and the licence that each is under, as published.
_LICENSED = [
    ("overture", "CDLA-Permissive-2.0"), ("fsq_closed", "Apache-2.0"), ("atp", "CC0-1.0"), ("wikidata_p576", "CC0-1.0"), ("biz_nola", "CC0-1.0"), ("osm_history", "ODbL-1.0"), ("dol_wa", "ODbL-1.0"),
    ("abca_dc_cancelled", "CC-BY-4.0"), ("childcare_ca", "CC-BY-4.0"), ("childcare_co", "PDDL-1.0"), ("childcare_tx", "none-stated"), ("dca_ca_auto", "none-stated"), ("sla_ny", "OPEN-NY-terms"), ("dohmh_nyc", "NYC-Open-Data-terms"),
    ("cdph_chicago_oob", "Chicago-Data-Portal-terms"), ("lb_boston", "PDDL-1.0"), ("sirene", "etalab-2.0"), ("snap_current", "US-public-domain"), ("foodsafety_ia", "none-stated"), ("abc_ky", "none-stated"),
]
_SRC = [x[0] for x in _LICENSED]
_SRC_SPARK = lambda: F.get(F.array(*[F.lit(x) for x in _SRC]), (c("l_orderkey") % len(_SRC)).cast("int"))
expr("fn_20_license_of", "", lambda: {"l_orderkey": c("l_orderkey"), "license": categories.license_of(_SRC_SPARK())}, {"l_orderkey": "l_orderkey", "license": _PICKED("l_orderkey", [x[1] for x in _LICENSED])}, table="lineitem")
for _key, _f, _i in (("fn_21_group_of", categories.group_of, 1), ("fn_22_subgroup_of", categories.subgroup_of, 2), ("fn_23_bucket", categories.bucket, 3)):
    expr(_key, "", lambda f=_f: {"p_partkey": c("p_partkey"), "named": f(_CAT_SPARK())}, {"p_partkey": "p_partkey", "named": _PICKED("p_partkey", [x[_i] for x in _EXPECTED])}, table="part")
_DS = lambda: F.when(c("dataset_no") == 0, F.array(F.lit("Foursquare"), F.lit("Overture"))).when(c("dataset_no") == 1, F.array(F.lit("meta"), F.lit("Microsoft"))).when(c("dataset_no") == 2, F.array(F.lit("BrightQuery")))
_DS_SQL = "case dataset_no when 0 then ['Foursquare', 'Overture'] when 1 then ['meta', 'Microsoft'] when 2 then ['BrightQuery'] end"
expr("fn_24_overture_sources_of", "fx_base", lambda: {"id": c("id"), "sources": F.array_join(score.base_sources(_DS()), ",")}, {"id": "id", "sources": f"array_to_string(list_sort(list_filter(list_transform({_DS_SQL}, lambda d: lower(d)), lambda d: d not in ('overture', 'overture-signals'))), ',')"})
_VOUCH_SQL = "case when dataset_no = 3 then 75e-2 when dataset_no = 0 then 25e-2 when dataset_no = 2 then 4e-1 else 6e-1 end"
expr("fn_25_unvouched_score", "fx_base", lambda: {"id": c("id"), "base": score.unvouched_score(F.concat(F.lit("ovt:"), "id"), F.lit(False), _DS()).cast("double")}, {"id": "id", "base": _VOUCH_SQL})
expr("fn_27_source_family", "fx_evidence", lambda: {"place_id": c("place_id"), "source_id": c("source_id"), "family": text.source_family(c("source"))}, {"place_id": "place_id", "source_id": "source_id", "family": "split_part(source, '_', 1)"})
expr("fn_28_hours_fallback", "fx_base", lambda: {"id": c("id"), "hours": text.hours_fallback(F.when(c("dataset_no") == 1, F.lit("  ")).otherwise(c("brand")))}, {"id": "id", "hours": "case when dataset_no = 1 then null else brand end"})


def _met(a: DataFrame, b: DataFrame, name: str, *keys: str, traits: bool = False) -> DataFrame:
    """(keys, a_{name}, a_id, b_{name}, b_id): the different names of two tables that meet by equal keys, each with its rows'
    ids and, with ``traits``, what the name test asks of it."""

    def side(df: DataFrame, n: str) -> DataFrame:
        one = groups.gathered(df.select(*keys, c(name).alias(f"{n}_{name}"), c("id").alias(f"{n}_id")), [*keys, f"{n}_{name}"], f"{n}_id")
        one = one.withColumn(f"{n}_nn", text.norm_name(c(f"{n}_name"))) if traits and name == "name" else one
        one = one.select("*", *similarity.traits(c(f"{n}_nn"), n)) if traits else one
        return groups.dealt(one.where(" and ".join(f"{k} is not null" for k in keys)), *keys)

    return side(a, "a").join(side(b, "b"), list(keys))


@q("fn_05_name_sim", Q.query(f"select x.id as a_id, y.id as b_id, {Q.rnd(Q.sim('x.nn', 'y.nn'), 3)} as sim from base_n x join chain_n y on x.category = y.category and x.hn = y.hn", Q.BASE_N, Q.CHAIN_N))
def _(d: Data):
    pairs = similarity.with_similarity(_met(d.base(), d.chain(), "nn", "category", "hn"), "a_nn", "b_nn")
    return groups.spread(pairs.select("a_id", "b_id", geo.round_to(c("sim"), 3).alias("sim")), "a_id", "b_id")


@q("fn_06_jaro_winkler", Q.query(f"select x.id as a_id, y.id as b_id, {Q.rnd('jaro_winkler_similarity(x.name, y.name)', 6)} as jw from fx_base x join fx_chain y on x.category = y.category and substr(x.id, 1, 1) = 'g' and length(x.name) < length(y.name)"))
def _(d: Data):
    both = _met(d.view("select * from fx_base where id like 'g%'"), d.view("select * from fx_chain"), "name", "category")
    both = both.where(F.length("a_name") < F.length("b_name")).withColumn("jw", geo.round_to(similarity.jaro_winkler("a_name", "b_name"), 6))
    return groups.spread(both.select("a_id", "b_id", "jw"), "a_id", "b_id")


_NEAR = "select x.id as a_id, y.id as b_id, {e} as ok from base_n x join chain_n y on x.category = y.category and x.hn = y.hn"


@q("fn_07_name_test", Q.query(_NEAR.format(e=Q.passing(f"({Q.sim('x.nn', 'y.nn')})")), Q.BASE_N, Q.CHAIN_N))
def _(d: Data):
    both = _met(d.base(), d.chain(), "nn", "category", "hn", traits=True)
    return groups.spread(similarity.tested(both, "ok").select("a_id", "b_id", "ok"), "a_id", "b_id")


@q("fn_08_same_name", Q.query(_NEAR.format(e=Q.passing(f"({Q.sim('x.nn', 'y.nn')})")), Q.BASE_N, Q.CHAIN_N))
def _(d: Data):
    both = _met(d.base(), d.chain(), "name", "category", "hn", traits=True)  # with_same_name, each name normalized once
    return groups.spread(similarity.tested(both, "ok").select("a_id", "b_id", "ok"), "a_id", "b_id")


_SCORE_SQL = f"""case when s.status = 'closed' then 1e-1 when s.status_date is not null then greatest(case when s.conflict then 8e-1 else 97e-2 end * pow(9e-1, greatest({Q.BUILD} - s.status_date, 0) / 36525e-2), case when s.conflict then 5e-1 else 75e-2 end)
  when b.operating_status = 'permanently_closed' then 3e-1 else {_VOUCH_SQL} end"""


@q("fn_26_open_score", Q.query(f"select b.id, {Q.rnd(_SCORE_SQL, 2)} as open_score from fx_base b left join st s on s.place_id = b.id", f"st as ({Q.status('fx_evidence')})"))
def _(d: Data):
    df = d.view("select * from fx_base").join(d.status().withColumnRenamed("status", "st"), c("id") == c("place_id"), "left")
    base = score.unvouched_score(F.concat(F.lit("ovt:"), "id"), F.lit(False), _DS())
    return df.select("id", score.open_score(F.coalesce("st", F.lit("unknown")), c("status_date"), F.coalesce("conflict", F.lit(False)), c("operating_status"), F.lit(None).cast("boolean"), F.lit(None).cast("double"), BUILD, base).alias("open_score"))


# --- positions ---------------------------------------------------------------------------------------------------
expr("geo_01_dist_m", "fx_base", lambda: {"id": c("id"), "m": geo.round_to(geo.dist_m(c("lat"), c("lng"), F.lit(38.9), F.lit(-77.0)), 1)}, {"id": "id", "m": Q.rnd("111320e0 * sqrt(pow(lat - 389e-1, 2) + pow((lng + 77e0) * cos(radians((lat + 389e-1) / 2)), 2))", 1)})
expr("geo_05_cell_xy", "fx_base", lambda: {"id": c("id"), "cy": geo.cell_y(c("lat")), "cx": geo.cell_x(c("lng"))}, {"id": "id", "cy": "cast(floor(lat / 4e-3) as int)", "cx": "cast(floor(lng / 8e-3) as int)"})
# Outlines: the state DC with an island, a lake and an islet, and a plain neighbour that no query asks for.
_OUTLINE = "outline as (select x as x1, y as y1, coalesce(lead(x) over w, first_value(x) over w) as x2, coalesce(lead(y) over w, first_value(y) over w) as y2 from fx_outline window w as (partition by ring order by i))"
_T = "greatest(0e0, least(1e0, ((lng - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2))))"
_MET = f"""met as (select id, count(*) filter (where (y1 > lat) <> (y2 > lat) and lng < x1 + (lat - y1) / (y2 - y1) * (x2 - x1)) % 2 = 1 as inside,
  min(sqrt(pow(lng - x1 - {_T} * (x2 - x1), 2) + pow(lat - y1 - {_T} * (y2 - y1), 2))) as far from fx_base cross join outline group by id)"""


def outlines_of(d: Data) -> DataFrame:
    """(state, geometry): GeoJSON, made of the points of fx_outline."""
    ring = d.view("select * from fx_outline").groupBy("ring").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    ring = ring.select("ring", F.transform("p", lambda p: F.array(p["x"], p["y"])).alias("p")).groupBy().agg(F.transform(F.sort_array(F.collect_list(F.struct("ring", "p"))), lambda r: r["p"]).alias("r"))
    r = lambda i: c("r")[i]
    state = ring.select(F.lit("DC").alias("state"), F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(r(0), r(1)), F.array(r(2)), F.array(r(3))).alias("coordinates"))).alias("geometry"))
    other = d.spark.createDataFrame([("VA", '{"type":"Polygon","coordinates":[[[-77.2,38.7],[-76.8,38.7],[-76.8,39.1],[-77.2,38.7]]]}')], state.schema)
    return state.unionByName(other)


def _sides(d: Data) -> DataFrame:
    return settled(outline.edges(outlines_of(d)), "edges")


q("geo_02_point_in_polygon", Q.query("select id, inside from met", _OUTLINE, _MET))(lambda d: outline.with_inside(d.view("select id, lat, lng from fx_base"), _sides(d), "DC").select("id", "inside"))
q("geo_03_within_degrees", Q.query(f"select id, case when far <= 5e-2 then {Q.rnd('far', 6)} end as far, far <= 5e-2 as near from met", _OUTLINE, _MET))(
    lambda d: outline.with_degrees(d.view("select id, lat, lng from fx_base"), _sides(d), "DC", 0.05).select("id", geo.round_to(c("degrees"), 6).alias("far"), c("degrees").isNotNull().alias("near")))
# One geometry of each kind, as offsets from a position; the last has a point beside its area.
SHAPES = {
    "Point": (1e-3, 2e-3),
    "MultiPoint": [(0.0, 0.0), (2e-3, 1e-3), (4e-3, 5e-3)],
    "LineString": [(0.0, 0.0), (1e-2, 0.0), (1e-2, 2e-2)],
    "MultiLineString": [[(0.0, 0.0), (5e-3, 0.0)], [(0.0, 2e-3), (0.0, 9e-3), (3e-3, 9e-3)]],
    "Polygon": [[(0.0, 0.0), (2e-2, 0.0), (2e-2, 1e-2), (0.0, 1e-2), (0.0, 0.0)], [(1e-3, 1e-3), (1e-3, 5e-3), (6e-3, 5e-3), (6e-3, 1e-3), (1e-3, 1e-3)]],
    "MultiPolygon": [[[(0.0, 0.0), (1e-2, 0.0), (5e-3, 8e-3), (0.0, 0.0)]], [[(2e-2, 0.0), (2e-2, 6e-3), (3e-2, 6e-3), (3e-2, 0.0), (2e-2, 0.0)], [(2.2e-2, 1e-3), (2.6e-2, 1e-3), (2.6e-2, 3e-3), (2.2e-2, 1e-3)]]],
}
KINDS = [*SHAPES, "GeometryCollection"]


def _geometry(kind: Column, x: Column, y: Column) -> Column:
    """GeoJSON of the shape of number ``kind`` at a position."""
    nest = lambda v: F.array(x + v[0], y + v[1]) if isinstance(v, tuple) else F.array(*[nest(e) for e in v])
    text_of = {k: F.to_json(F.struct(F.lit(k).alias("type"), nest(v).alias("coordinates"))) for k, v in SHAPES.items()}
    text_of["GeometryCollection"] = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), text_of["Point"], F.lit(","), text_of["Polygon"], F.lit("]}"))
    return F.coalesce(*[F.when(kind == i, text_of[k]) for i, k in enumerate(KINDS)])


def _middles_sql() -> str:
    """(kind, cx, cy): each shape's centroid, from its vertices: areas by the shoelace formula, lines by length, points by mean."""
    rows = []

    def walk(kind: int, v, dim: int, path: tuple) -> None:
        if isinstance(v, tuple):
            rows.append((kind, dim, *(path[:-1] + (0, 0, 0))[:2], path[-1] if path else 0, v))
        else:
            for i, e in enumerate(v):
                walk(kind, e, dim, (*path, i))

    for k, (name, v) in enumerate(SHAPES.items()):
        walk(k, [v] if name == "Polygon" else v, 0 if "Point" in name else 1 if "Line" in name else 2, ())
    walk(len(SHAPES), [SHAPES["Polygon"]], 2, ())
    values = ", ".join(f"({k}, {d}, {p}, {r}, {i}, {v[0]!r}::double, {v[1]!r}::double)" for k, d, p, r, i, v in rows)
    return f"""middles as (select kind, case dim when 2 then sum(hole * area * mx) / sum(hole * area) when 1 then sum(len * mx) / sum(len) else avg(x) end as cx, case dim when 2 then sum(hole * area * my) / sum(hole * area) when 1 then sum(len * my) / sum(len) else avg(y) end as cy
      from (select kind, dim, ring, part, case when dim = 2 and ring > 0 then -1 else 1 end as hole, abs(sum(w) / 2) as area, any_value(x) as x, any_value(y) as y, case dim when 2 then sum((x + x2) * w) / (3 * sum(w)) else sum((x + x2) / 2 * seg) / nullif(sum(seg), 0) end as mx,
              case dim when 2 then sum((y + y2) * w) / (3 * sum(w)) else sum((y + y2) / 2 * seg) / nullif(sum(seg), 0) end as my, sum(seg) as len
            from (select *, x * y2 - x2 * y as w, sqrt(pow(x - x2, 2) + pow(y - y2, 2)) as seg
                  from (select *, lead(x) over v as x2, lead(y) over v as y2 from (values {values}) s(kind, dim, part, ring, i, x, y) window v as (partition by kind, part, ring order by i)))
            group by kind, dim, part, ring, case when dim = 0 then i end) group by kind, dim)"""


_AT_SQL = f"select id, {Q.rnd('lng + cx', 6)} as x, {Q.rnd('lat + cy', 6)} as y from fx_base join middles on kind = cast(substr(id, 2) as int) % {len(KINDS)}"


@q("geo_04_centroid", Q.query(_AT_SQL, _middles_sql()))
def _(d: Data):
    kind = F.substring("id", 2, 20).cast("int") % len(KINDS)
    rows = shapes.with_centroid(d.view("select id, lat, lng from fx_base").select("id", _geometry(kind, c("lng"), c("lat")).alias("geometry")), x="x", y="y")
    return rows.select("id", geo.round_to(c("x"), 6).alias("x"), geo.round_to(c("y"), 6).alias("y"))


def _lambert_sql() -> str:
    """The inverse conic as a chain of subqueries: the isometric latitude, then six steps to the latitude."""
    e, first = "818191910428158e-16", "select id, dx, dy, exp(-ln(sqrt(dx * dx + dy * dy) / 11754255426096e-6) / 7256077650532670e-16) as t from (select id, 65e4 + (lng + 77e0) * 1e5 - 7e5 as dx, 686e4 + (lat - 388e-1) * 1e5 - 12655612049876e-6 as dy from fx_base)"
    out = f"select *, 2e0 * atan(t) - pi() / 2e0 as phi from ({first})"
    for _ in range(6):
        out = f"select id, dx, dy, t, 2e0 * atan(t * pow((1e0 + {e} * sin(phi)) / (1e0 - {e} * sin(phi)), {e} / 2e0)) - pi() / 2e0 as phi from ({out})"
    return f"select id, {Q.rnd('degrees(atan(-dx / dy) / 7256077650532670e-16) + 3e0', 7)} as lng, {Q.rnd('degrees(phi)', 7)} as lat from ({out})"


@q("geo_06_reproject_lambert93", Q.query(_lambert_sql()))
def _(d: Data):
    x, y = F.lit(650_000.0) + (c("lng") + 77) * 100_000, F.lit(6_860_000.0) + (c("lat") - 38.8) * 100_000
    placed = d.view("select * from fx_base").select("id", x.alias("x"), y.alias("y"))  # apart: an alias lng would stand for the column in the next one
    return placed.select("id", *[geo.round_to(geo.lambert93(c("x"), c("y"), part), 7).alias(part) for part in ("lng", "lat")])


# --- matching ----------------------------------------------------------------------------------------------------
_GRID = f"""select a.id as a_id, b.id as b_id, {Q.rnd(Q.metres(), 1)} as dist from fx_base a join fx_chain b
  on abs(cast(floor(a.lat / 4e-3) as int) - cast(floor(b.lat / 4e-3) as int)) <= 1 and abs(cast(floor(a.lng / 8e-3) as int) - cast(floor(b.lng / 8e-3) as int)) <= 1"""


@q("join_01_grid_candidates", Q.query(_GRID))
def _(d: Data):
    return match.grid_candidates(d.base(), d.chain())


for _k, _rule, _f in (("join_02_match_number", "number", match.match_number), ("join_03_match_near", "near", match.match_near), ("join_04_match_spot", "spot", match.match_spot)):
    q(_k, Q.query(f"select * from p where rule = '{_rule}'", Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN))(lambda d, f=_f: f(d.base(), d.chain()))
q("join_05_match_pairs", Q.query("select * from p", Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN))(lambda d: d.pairs())
q("join_06_self_match", Q.query("select * from dup", Q.BASE_N, Q.DUPES))(lambda d: match.self_match(d.base()))
q("join_07_match_address", Q.query(Q.address_pairs("base_n", "(select * from reg_n where lat is null)"), Q.BASE_N, Q.REG_N))(lambda d: match.match_address(d.base(), d.register().where("lat is null")))
q("join_08_best_match", Q.query("select * from best", Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN, Q.B_CHAIN))(lambda d: match.best_match(d.pairs()))
QUERIES["win_01_rank_best_rule"], ORACLES["win_01_rank_best_rule"] = QUERIES["join_08_best_match"], ORACLES["join_08_best_match"]
q("win_06_any_number_flag", Q.query("select a_id, b_id, rule, bool_or(rule = 'number') over (partition by b_id) as any_number from p", Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN))(lambda d: match.any_number(d.pairs()).select("a_id", "b_id", "rule", "any_number"))
q("join_09_matched_evidence", Q.query("select * from ev", Q.BASE_N, Q.REG_N, Q.EV))(lambda d: match.attach_evidence(d.base(), d.register()))
_MEMBERS = "members as (select coalesce(b.a_id, n.id) as place_id, 'atp' as source, n.id as source_id, coalesce(b.rule, 'self') as rule, coalesce(b.dist, 0e0) as dist, coalesce(b.sim, 1e0) as sim from chain_n n left join best b on b.b_id = n.id)"
_CH = (Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN, Q.B_CHAIN)
q("join_17_membership", Q.query("select * from members", *_CH, _MEMBERS))(lambda d: match.members(d.chain(), match.best_match(d.pairs()), "atp"))
q("join_18_unmatched_rows", Q.query("select id, name, nn, hn from chain_n where id not in (select b_id from best)", *_CH))(lambda d: match.unmatched(d.chain(), match.best_match(d.pairs())).select("id", "name", "nn", "hn"))
_FILL = "select a_id as place_id, b_id as id, dist, name, category from best join chain_n on id = b_id qualify row_number() over (partition by a_id order by dist, b_id) = 1"
q("join_23_fill_row", Q.query(_FILL, *_CH))(lambda d: match.fill_row(match.best_match(d.pairs()), d.chain()).select("place_id", "id", "dist", "name", "category"))
QUERIES["win_03_nearest_member"], ORACLES["win_03_nearest_member"] = QUERIES["join_23_fill_row"], ORACLES["join_23_fill_row"]
q("flt_08_gap_fill", Q.query(f"select b.id, b.name, coalesce(b.category, nullif(f.category, '')) as category from base_n b left join ({_FILL}) f on f.place_id = b.id", *_CH))(
    lambda d: match.gap_fill(d.base(), match.fill_row(match.best_match(d.pairs()), d.chain()), ["category"]).select("id", "name", "category"))

# --- duplicates --------------------------------------------------------------------------------------------------
_CANON = (Q.BASE_N, Q.DUPES, Q.CANON)


def _base_full(d: Data) -> DataFrame:
    return d.base().withColumn("datasets", _DS())


q("graph_01_canonical_ids", Q.query("select * from canon", *_CANON))(lambda d: canon.canonical_ids(d.base(), match.self_match(d.base())))
_MERGE = f"""select b.id, coalesce(b.category, f.category) as category, coalesce(b.brand, f.brand) as brand, coalesce(b.postcode, f.postcode) as postcode, f.has_dataset, f.st as operating_status
  from base_n b join (select k.place_id, arg_min(o.category, o.id) filter (where o.category is not null) as category, arg_min(o.brand, o.id) filter (where o.brand is not null) as brand, arg_min(o.postcode, o.id) filter (where o.postcode is not null) as postcode,
    coalesce(bool_or(list_contains({_DS_SQL}, 'Foursquare')), false) as has_dataset, case when bool_and(o.operating_status = 'permanently_closed') then 'permanently_closed' else arg_min(o.operating_status, o.id) filter (where o.operating_status <> 'permanently_closed') end as st
    from canon k join base_n o on o.id = k.id group by k.place_id) f on f.place_id = b.id"""


def _merged(d: Data) -> DataFrame:
    b = _base_full(d)
    return canon.merge_duplicates(b, canon.canonical_ids(b, match.self_match(b)), ["category", "brand", "postcode"], "Foursquare")


q("agg_01_fill_from_duplicates", Q.query(_MERGE, *_CANON))(lambda d: _merged(d).select("id", "category", "brand", "postcode", "has_dataset", "operating_status"))
q("agg_02_closed_only_if_all", Q.query(f"select id, operating_status from ({_MERGE}) where operating_status is not null", *_CANON))(lambda d: _merged(d).where("operating_status is not null").select("id", "operating_status"))

# --- evidence ----------------------------------------------------------------------------------------------------
_REASON = "case when lat is not null and lng is not null and not (lat between 17 and 72 and lng between -180 and -64) then 'position out of range' when lat is null and {z} is null then 'no position and no ZIP' when date is null then 'no date' when coalesce(trim(name), '') = '' then 'no name' end".format(z=Q.zip5("address"))
_VALID = f"v as (select *, case when reason is null and row_number() over (partition by source, source_id, reason order by date desc, state, name, address) > 1 then 'same id twice' else reason end as why from (select *, {_REASON} as reason from fx_register))"
q("flt_05_valid_evidence", Q.query("select source, source_id, name, state, date from v where why is null", _VALID))(lambda d: evidence.validate(d.view("select * from fx_register"), BUILD)[0].select("source", "source_id", "name", "state", "date"))
q("reg_12_drop_report", Q.query("select source, state, why as reason, count(*) as n from v where why is not null group by all", _VALID))(lambda d: evidence.validate(d.view("select * from fx_register"), BUILD)[1])
_BOX = (38.85, -77.05, 38.95, -76.95)
_REGION = f"select source, source_id, date from reg_n where date between date '1900-01-01' and {Q.BUILD} and ((lat between 3885e-2 and 3895e-2 and lng between -7705e-2 and -7695e-2) or (lat is null and zip in (select zip from base_n)))"
q("flt_04_register_in_region", Q.query(_REGION, Q.BASE_N, Q.REG_N))(lambda d: evidence.in_region(d.register(), d.base(), BUILD, _BOX).select("source", "source_id", "date"))
q("flt_06_independents_only", Q.query("select * from ev where not (source = 'out_cancelled' and place_id in (select id from base_n where brand is not null))", Q.BASE_N, Q.REG_N, Q.EV))(
    lambda d: evidence.independents_only(match.attach_evidence(d.base(), d.register()), d.base(), ("out_cancelled",)))
_FSQ = f"closed as (select *, {Q.norm('name')} as nn from (select fsq_id as fsq_place_id, case when dataset_no = 1 then 'other ' || name else upper(name) end as name, address, date '2001-03-01' + cast(dataset_no as int) as date_closed from fx_base where dataset_no in (0, 1) and fsq_id is not null))"


def _closed(d: Data) -> DataFrame:
    return d.view("select fsq_id as fsq_place_id, case when dataset_no = 1 then 'other ' || name else upper(name) end as name, address, date_add(date '2001-03-01', cast(dataset_no as int)) as date_closed from fx_base where dataset_no in (0, 1) and fsq_id is not null")


_ATT = "'{src}' as source, {sid} as source_id, '{st}' as state, {day} as date, {rule} as rule, {dist} as dist, {nm} as ev_name, {ad} as ev_address"
q("join_10_id_closures", Q.query(f"select k.place_id, {_ATT.format(src='fsq_closed', sid='f.fsq_place_id', st='closed', day='f.date_closed', rule="'id'", dist='0e0', nm='f.name', ad='f.address')} from base_n o join canon k on k.id = o.id join closed f on f.fsq_place_id = o.fsq_id where {Q.passing('(' + Q.sim('f.nn', 'o.nn') + ')')}", *_CANON, _FSQ))(
    lambda d: evidence.id_closures(d.base(), canon.canonical_ids(d.base(), match.self_match(d.base())), _closed(d)))
_HIST_SQL = "select id as overture_id, case when dataset_no = 2 then name else 'quite other place' end as osm_name, case when dataset_no = 3 then 'someone else' else upper(name) end as overture_name, case dataset_no when 0 then 'hard_delete' when 1 then 'substantial_rename' when 2 then 'substantial_rename' else 'primary_tag_deleted' end as event, date '2001-02-03' as event_date, cast(dataset_no as double) / 4e0 as conf_mean from fx_base"
_HIST = f"hist as (select *, {Q.norm('overture_name')} as nn, {Q.norm('osm_name')} as renamed from ({_HIST_SQL}))"
q("join_11_history_closures", Q.query(f"select k.place_id, {_ATT.format(src='osm_history', sid='h.overture_id', st='closed', day='h.event_date', rule="'id'", dist='0e0', nm='h.event', ad='cast(null as varchar)')} from hist h join base_n o on o.id = h.overture_id join canon k on k.id = o.id where {Q.passing('(' + Q.sim('h.nn', 'o.nn') + ')')} and not (h.event = 'substantial_rename' and h.osm_name is not null and {Q.passing('(' + Q.sim('h.renamed', 'o.nn') + ')')})", *_CANON, _HIST))(
    lambda d: evidence.history_closures(d.base(), canon.canonical_ids(d.base(), match.self_match(d.base())), d.view(_HIST_SQL)))
_FEAT = "select id, name, 'N Main St' as address, category, collected as edited, case when length(id) % 3 = 0 then 'disused' end as lifecycle, case length(name) % 4 when 0 then '2000-05-06' when 1 then '2000' when 2 then '1999-01' else 'soon' end as end_date, case length(name) % 3 when 0 then '2001-04-05' when 1 then '2001-04' end as check_date, 'Q' || cast(length(name) as string) as wikidata, replace(id, 'sp', 's p ') as siret from fx_chain"
_FEAT_SQL = "feat as (" + _FEAT.replace("as string", "as varchar") + ")"


def _features(d: Data) -> DataFrame:
    return d.view(_FEAT)


def _members(d: Data) -> DataFrame:
    return match.members(d.chain(), match.best_match(d.pairs()), "osm")


_F = (*_CH, _MEMBERS, _FEAT_SQL)
_FJ = "from members m join feat o on o.id = m.source_id"
_DAY = lambda x: f"case when regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then try_cast({x} as date) end"
_att = lambda src, sid, st, day: _ATT.format(src=src, sid=sid, st=st, day=day, rule="m.rule", dist="m.dist", nm="o.name", ad="o.address")
q("join_14_lifecycle_evidence", Q.query(f"select m.place_id, {_att('osm_lifecycle', 'o.id', 'closed', f'coalesce({_DAY("o.end_date")}, o.edited)')} {_FJ} where o.lifecycle is not null", *_F))(lambda d: evidence.lifecycle_closures(_members(d), _features(d)))
q("join_15_survey_evidence", Q.query(f"select m.place_id, {_att('osm_check_date', 'o.id', 'open', _DAY('o.check_date'))} {_FJ} where o.lifecycle is null and {_DAY('o.check_date')} is not null", *_F))(lambda d: evidence.survey_open(_members(d), _features(d)))
_ITEMS = "select distinct 'Q' || cast(length(name) as string) as qid, date '1998-07-06' as date from fx_chain where length(name) % 2 = 0"
q("join_13_dissolved_items", Q.query(f"select m.place_id, {_att('wikidata_p576', 'o.wikidata', 'closed', 'w.date')} {_FJ} join items w on w.qid = o.wikidata where o.category not like 'office=%'", *_F, f"items as ({_ITEMS.replace('as string', 'as varchar')})"))(lambda d: evidence.item_closures(_members(d), _features(d), d.view(_ITEMS)))
_TAGR = "select 'sirene' as source, replace(replace(id, 'sp', 's p '), ' ', '') as source_id, 'open' as state, collected as date, name, 'x' as address from fx_chain where length(name) % 2 = 1"
q("join_12_exact_id_evidence", Q.query(f"select m.place_id, r.source, r.source_id, r.state, r.date, 'id' as rule, 0e0 as dist, r.name as ev_name, r.address as ev_address {_FJ} join (select *, 1 as k from ({_TAGR})) r on r.source_id = replace(o.siret, ' ', '')", *_F))(lambda d: evidence.tagged_id_evidence(_members(d), _features(d), d.view(_TAGR)))
q("join_16_locator_evidence", Q.query(f"select m.place_id, {_att('atp', 'o.id', 'open', 'o.collected')} from members m join (select *, 'N Main St' as address from chain_n where category is not null) o on o.id = m.source_id", *_CH, _MEMBERS))(
    lambda d: evidence.locator_open(_members(d), d.chain().where("category is not null").withColumns({"address": F.lit("N Main St"), "end_date": F.lit(None).cast("string")})))
_ST = Q.status("fx_evidence")
q("agg_03_status_of", Q.query(f"select place_id, status, status_date, status_source, conflict from ({_ST})"))(lambda d: d.status().drop("evidence"))
q("agg_04_evidence_list", Q.query(f"select place_id, ev as evidence from ({_ST})"))(lambda d: d.status().select("place_id", evidence.evidence_text("evidence").alias("evidence")))

# --- minting -----------------------------------------------------------------------------------------------------
_FRONT = ", ".join(f"'{x}'" for x in STOREFRONTS)
_KIND = "case source " + " ".join(f"when '{k}' then '{v}'" for k, v in STOREFRONTS.items()) + " end"
_ELIG = f"elig as (select *, {_KIND} as category from reg_n r where source in ({_FRONT}) and state = 'open' and lat is not null and not exists (select 1 from ev e where e.source = r.source and e.source_id = r.source_id) and name not ilike 'tbd%' and not regexp_matches(lower(name), '\\b({text.LEGAL_ENDING})\\.?\\s*[0-9]*$'))"
_LOOK = f"look as (select distinct a.id from elig a join base_n b on abs(a.lat - b.lat) < 3e-3 and abs(a.lng - b.lng) < 4e-3 where ({Q.metres()} <= 200 and ({Q.sim('a.nn', 'b.nn')}) >= 9e-1) or ({Q.metres()} <= 80 and (jaro_winkler_similarity(a.nn, b.nn) >= 7e-1 or (a.hn = b.hn and split_part(a.nn, ' ', 1) = split_part(b.nn, ' ', 1)))))"
_BORN = "born as (select *, 'new:' || source || '/' || source_id as place_id from elig where id not in (select id from look) qualify row_number() over (partition by nn, hn, floor(lat / 4e-3), floor(lng / 8e-3) order by source, source_id) = 1)"
_M = (Q.BASE_N, Q.REG_N, Q.EV, _ELIG)


def _eligible(d: Data) -> DataFrame:
    return mint.storefront_eligible(d.register(), match.attach_evidence(d.base(), d.register()), STOREFRONTS)


def _born(d: Data) -> DataFrame:
    return mint.born(d.register(), d.base(), match.attach_evidence(d.base(), d.register()), STOREFRONTS)


q("flt_07_storefront_eligible", Q.query("select id, source, source_id, category from elig", *_M))(lambda d: _eligible(d).select("id", "source", "source_id", "category"))
q("join_19_lookalikes", Q.query("select id from look", *_M, _LOOK))(lambda d: mint.lookalikes(_eligible(d), d.base()))
q("win_05_dedupe_minted", Q.query("select place_id, nn, hn from born", *_M, _LOOK, _BORN))(lambda d: _born(d).select("place_id", "nn", "hn"))
q("join_20_mint_places", Q.query(f"select place_id as id, {Q.display('name')} as name, category, {Q.title("split_part(address, ', ', 1)")} as address, nullif({Q.title("split_part(address, ', ', 2)")}, '') as city, nullif(regexp_extract(address, ', ([A-Z]{{2}}) [0-9]{{5}}', 1), '') as region, zip as postcode, hn, sk from born", *_M, _LOOK, _BORN))(
    lambda d: mint.minted_places(_born(d)).select("id", "name", "category", "address", "city", "region", "postcode", "hn", "sk"))
_INSERT = "select place_id, source, source_id, state, date, rule, ev_name, ev_address from (select * from ev union all select place_id, source, source_id, state, date, 'self' as rule, 0e0 as dist, name, address from born)"
q("set_02_insert_rows", Q.query(_INSERT, *_M, _LOOK, _BORN))(lambda d: match.attach_evidence(d.base(), d.register()).unionByName(mint.minted_evidence(_born(d))).drop("dist"))

# --- score and publish -------------------------------------------------------------------------------------------
_HOURS = "select 'g' || lpad(cast(n as string), 7, '0') as place_id, case when n % 4 = 0 then ' ' else p_brand end as hours, case when n % 2 = 0 then 'atp' else 'osm' end as source, date '2001-01-01' as day from fx_b union all select 'g' || lpad(cast(n as string), 7, '0'), p_type, 'osm', case when n % 3 = 0 then date '2001-02-01' else date '2000-02-01' end from fx_b where n % 5 < 3"
_HOURS_SQL = f"select place_id, arg_max(hours, row(day, source, hours)) as opening_hours, arg_max(source, row(day, source, hours)) as hours_source, max(day) as hours_date from ({_HOURS.replace('as string', 'as varchar')}) where nullif(trim(hours), '') is not null group by place_id"
q("agg_07_hours_newest", Q.query(_HOURS_SQL))(lambda d: score.hours(d.view(_HOURS)))
q("agg_08_max_confidence", Q.query("select k.place_id, max(h.conf_mean) as conf from hist h join canon k on k.id = h.overture_id where h.conf_mean is not null group by 1", *_CANON, _HIST))(lambda d: score.confidence(d.view(_HIST_SQL), canon.canonical_ids(d.base(), match.self_match(d.base()))))
_ALLM = f"allm as (select place_id, source, source_id from members union all select id, 'overture', id from base_n)"


def _all_members(d: Data) -> DataFrame:
    own = d.base().select(c("id").alias("place_id"), F.lit("overture").alias("source"), c("id").alias("source_id"))
    return match.members(d.chain(), match.best_match(d.pairs()), "atp").select("place_id", "source", "source_id").unionByName(own)


_ROLL = f"select place_id, string_agg(source || ':' || source_id, ',' order by source, source_id) as sources, array_to_string(list_sort(list(distinct {Q.case_of('source', categories.LICENSES, f"'{categories.OTHER_LICENSE}'")})), ',') as licenses, bool_or(source in ('osm', 'atp')) as in_map from allm group by place_id"
q("agg_09_member_rollup", Q.query(_ROLL, *_CH, _MEMBERS, _ALLM))(
    lambda d: score.member_rollup(_all_members(d)).select("place_id", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["source"], s["id"])), ",").alias("sources"), F.array_join("member_licenses", ",").alias("licenses"), "in_map"))
_BARS = "bars as (select id, case when dataset_no < 2 then 'bar' else category end as category, region from fx_base)"
_MISS = "select b.id, not exists (select 1 from fx_ev2 e where e.place_id = b.id and e.source = case b.region when 'DC' then 'alpha_x' else 'beta_z' end) as missing from bars b where b.category = 'bar' and b.region in ('DC', 'NY')"
q("join_22_missing_license", Q.query(_MISS, _BARS, "fx_ev2 as (select place_id, source from fx_evidence)"))(
    lambda d: score.missing_license(d.base().withColumn("category", F.when(c("dataset_no") < 2, "bar").otherwise(c("category"))), d.status(), {"DC": "alpha_x", "NY": "beta_z"}))


def _published(d: Data) -> DataFrame:
    place = d.base().withColumns({x: F.lit(None).cast("string") for x in ("brand_wikidata", "city", "phone", "website")}).withColumns({"has_dataset": c("dataset_no") == 0, "overture_status": c("operating_status")})
    listings = _base_full(d).select("id", F.lit(None).cast("string").alias("category_group"), F.lit(None).cast("string").alias("category_subgroup"), "datasets")
    conf = d.view(_HIST_SQL).select(c("overture_id").alias("place_id"), c("conf_mean").alias("conf"))
    return score.published(place, _all_members(d), d.status(), conf, score.hours(d.view(_HOURS)), listings, BUILD, LISTS)


_PUB_SCORE = f"""case when st = 'closed' then 1e-1 when status_date is not null then greatest(case when conflict then 8e-1 else 97e-2 end * pow(9e-1, greatest({Q.BUILD} - status_date, 0) / 36525e-2), case when conflict then 5e-1 else 75e-2 end)
  when operating_status = 'permanently_closed' then 3e-1 when conf >= 8e-1 then conf else 75e-2 end"""
_PUB = f"""select b.id, b.name, coalesce(s.status, 'unknown') as status, s.status_date, s.status_source, h.opening_hours, h.hours_source, r.sources, coalesce(s.ev, '') as evidence, {Q.rnd('t.conf', 2)} as openpois_conf, {Q.rnd(_PUB_SCORE.replace('st =', "coalesce(s.status, 'unknown') ="), 2)} as open_score
  from base_n b join roll r on r.place_id = b.id left join ({_ST}) s on s.place_id = b.id left join (select id as place_id, cast(dataset_no as double) / 4e0 as conf from fx_base) t on t.place_id = b.id left join ({_HOURS_SQL}) h on h.place_id = b.id"""
q("join_21_publish_join", Q.query(_PUB, *_CH, _MEMBERS, _ALLM, f"roll as ({_ROLL})"))(
    lambda d: _published(d).select("id", "name", "status", "status_date", "status_source", "opening_hours", "hours_source", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["source"], s["id"])), ",").alias("sources"), evidence.evidence_text("evidence").alias("evidence"), "openpois_conf", "open_score"))


@q("snk_01_publish_clustered", Q.query(f"select p.id, p.name, p.status, p.open_score, f.lat, f.lng from ({_PUB}) p join fx_base f on f.id = p.id", *_CH, _MEMBERS, _ALLM, f"roll as ({_ROLL})"))
def _(d: Data):
    path = d.folder()
    publish.publish_clustered(_published(d), path, fixtures.BOX)
    return d.spark.read.parquet(path).select("id", "name", "status", "open_score", "lat", "lng")


@q("snk_02_publish_status", Q.query(f"select id, status, status_date, status_source, open_score, cast(null as boolean) as missing_license from ({_PUB})", *_CH, _MEMBERS, _ALLM, f"roll as ({_ROLL})"))
def _(d: Data):
    path = d.folder()
    publish.status_file(_published(d)).write.parquet(path)
    return d.spark.read.parquet(path)


@q("snk_03_manifest")
def _(d: Data):
    path = d.folder()
    publish.publish_clustered(d.base().select("id", "name", "lat", "lng"), path, fixtures.BOX, files=4)
    return publish.manifest(d.spark, path, "core", "CDLA-Permissive-2.0")


# All regions, then one of them anew: its rows are the later ones, the others' the first.
@q("snk_06_publish_regions", Q.query("select id, case when region = 'DC' then upper(name) else name end as name, lat, lng, region from fx_base where region is not null"))
def _(d: Data):
    path, rows = d.folder(), d.view("select id, name, lat, lng, region from fx_base where region is not null")
    publish.publish_regions(rows, path)
    publish.publish_regions(rows.withColumn("name", F.upper("name")), path, ["DC"])
    return d.spark.read.parquet(path).select("id", "name", "lat", "lng", "region")


@q("snk_07_publish_layers", Q.query("select layer, region, count(*) as rows from (select 'places' as layer, region from fx_base union all select 'status', region from fx_base) where region is not null group by all"))
def _(d: Data):
    rows = d.view("select id, name, lat, lng, region from fx_base where region is not null")
    found = publish.publish_layers({"places": rows, "status": rows.select("id", "region")}, d.folder(), "ODbL-1.0")
    return found.groupBy("layer", "region").agg(F.sum("rows").alias("rows"))


_DIFF = """select coalesce(n.id, o.id) as id, case when o.id is null then 'appeared' when n.id is null then 'vanished' when o.status <> 'closed' and n.status = 'closed' then 'closed' when o.status = 'closed' and n.status = 'open' then 'reopened'
  when o.status = 'unknown' and n.status = 'open' then 'confirmed_open' when o.status = 'open' and n.status = 'unknown' then 'went_quiet' when o.status = 'closed' and n.status = 'unknown' then 'closure_withdrawn' end as change, o.status as old_status, n.status as new_status
  from (select * from fx_snap where half = 'cur') n full outer join (select * from fx_snap where half = 'prev') o on o.id = n.id where o.id is null or n.id is null or o.status <> n.status"""
_diff = lambda d: publish.snapshot_diff(d.snap("prev"), d.snap("cur"), ("id",))
q("join_24_snapshot_diff", Q.query(_DIFF))(_diff)
q("rep_08_change_summary", Q.query(f"select change, count(*) as places from ({_DIFF}) group by 1"))(lambda d: publish.change_summary(_diff(d)))
q("sort_04_ordered_report", Q.query(f"select change, count(*) as places from ({_DIFF}) group by 1 order by 2 desc, 1"))(lambda d: publish.change_summary(_diff(d)).orderBy(F.desc("places"), "change"))


@q("snk_04_publish_changes", Q.query(f"select 'all' as region, x.* from ({_DIFF}) x"))
def _(d: Data):
    path = d.folder()
    side = lambda h: d.snap(h).withColumn("region", F.lit("all"))
    publish.write_changes(publish.snapshot_diff(side("prev"), side("cur")), path)
    return d.spark.read.parquet(f"{path}/changes")


_HOLD = lambda h: f"select 'snap' as source, cast(id as string) as source_id, status as state from fx_snap where half = '{h}'"
_HOLD_SQL = lambda h: _HOLD(h).replace("as string", "as varchar")
q("snk_05_hold_records", Q.query(f"select * from ({_HOLD_SQL('cur')}) union all select * from ({_HOLD_SQL('prev')}) where source_id not in (select source_id from ({_HOLD_SQL('cur')}))"))(lambda d: monitor.hold(d.view(_HOLD("cur")), d.view(_HOLD("prev"))))


def _hilbert_sql() -> str:
    """One subquery a bit, from the highest: which quarter, and the turn within it."""
    grid = lambda v, lo, hi: f"cast(greatest(0, least(65535, floor(({v} - {lo!r}e0) / ({hi!r}e0 - {lo!r}e0) * 65536e0))) as bigint)"
    s, w, n, e = fixtures.BOX
    out = f"select id, {grid('lng', w, e)} as x, {grid('lat', s, n)} as y, cast(0 as bigint) as d from fx_base"
    for k in range(15, -1, -1):
        bits = f"select *, (x >> {k}) & 1 as right_half, (y >> {k}) & 1 as top_half from ({out})"
        quarter = "case when top_half = 1 then 1 + right_half else 3 * right_half end"
        turned = lambda v: f"case when top_half = 1 then {v} when right_half = 1 then 65535 - {'xy'[v == 'x']} else {'xy'[v == 'x']} end"
        out = f"select id, {turned('x')} as x, {turned('y')} as y, d + (cast({quarter} as bigint) << {2 * k}) as d from ({bits})"
    return f"select f.*, h.d as curve from fx_base f join ({out}) h on h.id = f.id"


q("sort_03_hilbert_order", Q.query(f"select id, curve from ({_hilbert_sql()})"))(lambda d: publish.hilbert_order(d.base(), fixtures.BOX).select("id", "curve"))

# --- filters -----------------------------------------------------------------------------------------------------
q("flt_01_clip_box", Q.query("select id, lat, lng from fx_base where lat between 3885e-2 and 3895e-2 and lng between -7705e-2 and -7695e-2"))(lambda d: d.view("select id, lat, lng from fx_base").where(geo.in_box(c("lat"), c("lng"), _BOX)))
q("flt_02_clip_outline", Q.query("select id from fx_base join met using (id) where inside or (coalesce(region = 'DC', false) and far <= 5e-2)", _OUTLINE, _MET))(lambda d: outline.clip(d.base(), outlines_of(d), "DC").select("id"))
q("flt_03_drop_non_places", Q.query("select id, category from fx_base where coalesce(category, '') not in ('STANDARD', 'PROMO')"))(lambda d: scan.drop_non_places(d.view("select id, category from fx_base"), ("STANDARD", "PROMO")))
q("flt_09_select_replace", Q.query("select * exclude (fsq_id, lat, lng) replace (upper(name) as name) from fx_base"))(lambda d: d.view("select * from fx_base").withColumn("name", F.upper("name")).drop("fsq_id", "lat", "lng"))
q("flt_10_trade_filters", "select p_partkey from part where regexp_matches(lower(p_name), 'red|blue|old') and not regexp_matches(lower(p_name), 'green') and p_type like 'S%' and not starts_with(p_type, 'SMALL')")(
    lambda d: d.table("part").where(registers.trade_filter(c("p_name"), ["red", "blue", "old"], ["green"]) & registers.trade_filter(c("p_type"), prefixes=["S"], not_prefixes=["SMALL"])).select("p_partkey"))
_EXP = lambda: F.when(c("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy")).when(c("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("never"))
q("flt_11_unexpired", "select o_orderkey from orders where o_orderkey % 3 = 2 or cast(o_orderdate as date) >= date '1996-06-01'")(lambda d: registers.unexpired(d.table("orders").withColumn("expires", _EXP()), "expires", date(1996, 6, 1)).select("o_orderkey"))

# --- registers ---------------------------------------------------------------------------------------------------
q("agg_05_newest_per_key", "select l_orderkey, l_linenumber, cast(l_shipdate as date) as day from lineitem qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber, l_partkey, l_suppkey) = 1")(
    lambda d: registers.newest(d.table("lineitem"), ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day")))
q("agg_06_max_date_group", "select l_partkey, l_suppkey, max(cast(l_shipdate as date)) as day from lineitem group by all having max(cast(l_shipdate as date)) >= date '1997-01-01'")(
    lambda d: registers.max_date_group(d.table("lineitem").select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day")), ["l_partkey", "l_suppkey"], "day", date(1997, 1, 1)))
_RAW = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, cast(l_shipdate as date) as visit, p_name, p_brand from lineitem join part on p_partkey = l_partkey"


def _raw(d: Data) -> DataFrame:
    p = d.table("part").select("p_partkey", "p_name", "p_brand")
    return d.table("lineitem").join(p, c("l_partkey") == c("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("visit"), "p_name", "p_brand")


_ID = lambda: F.concat_ws("-", "l_orderkey", "l_linenumber")
_ADDR = lambda: F.concat(F.lit("1 Main St, Town, DC 2"), F.lpad((c("l_suppkey") % 10_000).cast("string"), 4, "0"))
_EVID = lambda sel, where="", extra="": f"select {sel}, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as source_id, trim(p_name) as name, '1 Main St, Town, DC 2' || lpad(cast(l_suppkey % 10000 as varchar), 4, '0') as address, cast(null as double) as lat, cast(null as double) as lng from (select * from ({_RAW}) {where} {extra})"
_TODAY = date(2001, 11, 5)


def _spec(**more) -> registers.RegisterSpec:
    return registers.RegisterSpec(**({"source": "reg", "id": _ID(), "name": c("p_name"), "address": _ADDR()} | more))


q("reg_01_normalize_register", _EVID("'reg' as source, case when l_returnflag = 'R' then 'closed' else 'open' end as state, visit as date", "where l_linestatus = 'O'"))(
    lambda d: registers.normalize_register(_raw(d), _spec(state=F.when(c("l_returnflag") == "R", "closed").otherwise("open"), day=c("visit"), keep=c("l_linestatus") == "O"), _TODAY))
q("reg_02_list_active", _EVID("'reg' as source, 'open' as state, date '2001-11-05' as date", "where l_returnflag = 'N'"))(lambda d: registers.normalize_register(_raw(d), _spec(keep=c("l_returnflag") == "N"), _TODAY))
_ORD = "visit desc, l_orderkey, l_linenumber, p_name"
q("reg_03_list_inspections", _EVID("'reg' as source, 'open' as state, visit as date", "", f"qualify row_number() over (partition by l_partkey, l_suppkey order by {_ORD}) = 1"))(
    lambda d: registers.normalize_register(_raw(d), _spec(day=c("visit"), newest_by=["l_partkey", "l_suppkey"], newest_day="visit", order=["l_orderkey", "l_linenumber", "p_name"]), _TODAY))
q("reg_04_list_open_closed", _EVID("case when l_returnflag = 'R' then 'reg_oob' else 'reg' end as source, case when l_returnflag = 'R' then 'closed' else 'open' end as state, visit as date"))(
    lambda d: registers.normalize_register(_raw(d), _spec(source=F.when(c("l_returnflag") == "R", "reg_oob").otherwise("reg"), state=F.when(c("l_returnflag") == "R", "closed").otherwise("open"), day=c("visit")), _TODAY))
_LIVE = f"where l_returnflag = 'R' and (upper(trim(p_name)), l_suppkey) not in (select (upper(trim(p_name)), l_suppkey) from ({_RAW}) where l_returnflag = 'N')"
q("reg_05_list_cancelled", _EVID("'reg_cancelled' as source, 'closed' as state, visit as date", _LIVE))(
    lambda d: registers.normalize_register(_raw(d), _spec(source="reg_cancelled", state="closed", day=c("visit"), keep=c("l_returnflag") == "R", unless_live=(_raw(d).where("l_returnflag = 'N'"), ["p_name", "l_suppkey"])), _TODAY))
q("join_30_skip_reissued", f"select l_orderkey, l_linenumber from ({_RAW}) {_LIVE}")(lambda d: registers.skip_reissued(_raw(d).where("l_returnflag = 'R'"), _raw(d).where("l_returnflag = 'N'"), ["p_name", "l_suppkey"]).select("l_orderkey", "l_linenumber"))
q("reg_06_dedupe_license_rows", _EVID("'reg' as source, 'open' as state, visit as date", "", f"qualify row_number() over (partition by upper(p_name), l_suppkey order by {_ORD}) = 1"))(
    lambda d: registers.normalize_register(_raw(d), _spec(day=c("visit"), dedupe=[F.upper("p_name"), c("l_suppkey")], order=[F.desc("visit"), "l_orderkey", "l_linenumber", "p_name"]), _TODAY))
_SPOTS = "select n as p_partkey, min(row(lat, lng)) as p from (select cast(substr(id, 2) as bigint) as n, lat, lng from fx_base) group by n"


@q("reg_07_two_table_position", Q.query(f"select l_orderkey, l_linenumber, s.p[1] as lat, s.p[2] as lng from lineitem l left join ({_SPOTS}) s on s.p_partkey = l.l_partkey"))
def _(d: Data):
    spots = d.view("select cast(substr(id, 2) as bigint) as l_partkey, lat, lng from fx_base")
    rows = d.table("lineitem").withColumns({"lat": F.lit(None), "lng": F.lit(None)})
    return registers.with_position(rows, spots, "l_partkey").select("l_orderkey", "l_linenumber", "lat", "lng")


q("reg_08_newest_period", "select l_orderkey, l_linenumber from lineitem where year(l_shipdate) = (select max(year(l_shipdate)) from lineitem)")(lambda d: registers.newest_period(d.table("lineitem").withColumn("period", F.year("l_shipdate")), "period").select("l_orderkey", "l_linenumber"))
_ON = "case when l_linenumber % 2 = 0 then cast(l_shipdate as date) + 400 end"
q("reg_09_latest_of_two_dates", f"select l_orderkey, l_linenumber, greatest(cast(l_shipdate as date), {_ON}) as day from lineitem where not (l_returnflag = 'R' and ({_ON}) is null)")(
    lambda d: d.table("lineitem").withColumns({"a": F.to_date("l_shipdate"), "b": F.when(c("l_linenumber") % 2 == 0, F.date_add(F.to_date("l_shipdate"), 400)), "off": F.when(c("l_returnflag") == "R", F.to_date("l_shipdate"))})
    .where(~registers.deactivated(c("off"), c("b"))).select("l_orderkey", "l_linenumber", registers.latest_of(c("a"), c("b")).alias("day")))
q("reg_10_multi_layer_config", f"{_EVID("'reg_n' as source, 'open' as state, visit as date", "where l_returnflag = 'N'")} union all {_EVID("'reg_a' as source, 'closed' as state, visit as date", "where l_returnflag = 'A'")}")(
    lambda d: registers.normalize_many({"n": _raw(d), "a": _raw(d)}, {"n": _spec(source="reg_n", day=c("visit"), keep=c("l_returnflag") == "N"), "a": _spec(source="reg_a", state="closed", day=c("visit"), keep=c("l_returnflag") == "A")}, _TODAY))
# Rows of the tables in four registers' own columns.
_LANDED = {
    "dohmh_nyc": "cast(l_partkey as string) as camis, p_name as dba, cast(l_suppkey % 90 as string) as building, 'N MAIN ST' as street, 'Queens' as boro, '11101-22' as zipcode, '40.7' as latitude, if(l_partkey % 7 = 0, '0', '-73.9') as longitude, if(l_returnflag = 'A', '1900-01-01', date_format(visit, 'yyyy-MM-dd')) || 'T00:00:00.000' as inspection_date",
    "cdph_chicago": "if(l_suppkey % 50 = 0, '0', cast(l_partkey as string)) as license_, p_name as dba_name, case l_linenumber % 3 when 0 then '' when 1 then 'Sign ' || p_brand end as aka_name, ' ' || cast(l_suppkey % 90 as string) || ' N MAIN ST' as address, '60601' as zip, date_format(visit, 'yyyy-MM-dd') || 'T00:00:00.000' as inspection_date, case l_returnflag when 'R' then 'Out of Business' when 'N' then 'Pass' else 'No Entry' end as results, '41.9' as latitude, '-87.6' as longitude, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, visit) as inspection_id",
    "cpa_tx": "cast(l_orderkey as string) as tp_number, cast(l_linenumber as string) as loc_number, p_name as loc_name, cast(l_suppkey % 90 as string) as address_number, 'N MAIN ST' as address_text, 'WACO' as loc_city, '767' || lpad(cast(l_partkey % 100 as string), 2, '0') as loc_zip, 'TX' as loc_state, case l_suppkey % 4 when 0 then '445110' when 1 then '454110' when 2 then '722511' else '541110' end as naics, if(l_returnflag = 'R', visit, null) as out_of_business_date",
    "dmv_ny": "cast(l_partkey as string) as facility, p_name as facility_name, p_brand as facility_name_overflow, cast(l_suppkey % 90 as string) || ' N MAIN ST' as facility_street, 'Troy' as facility_city, '12180' as facility_zip_code, 'NY' as facility_state, if(l_linenumber = 4, null, date_format(date_add(visit, 1500), 'MM/dd/yyyy')) as expiration_date, if(l_partkey % 3 = 0, null, named_struct('coordinates', array(-73.6D, 42.7D))) as georeference",
}
_SPECS = f"""
raw as (select *, cast(l_suppkey % 90 as varchar) || ' N MAIN ST, ' as street from ({_RAW})),
visits as (select *, coalesce(case when l_linenumber % 3 = 1 then 'Sign ' || p_brand end, p_name) as sign, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_returnflag || '-' || visit as no from raw where l_suppkey % 50 <> 0 and l_partkey <> 0 and l_returnflag <> 'A' and visit > date '2001-11-05' - 1825),
garages as (select *, visit + 1500 as expires from raw where l_linenumber <> 4 and visit + 1500 >= date '2001-11-05')"""
_SPECS_SQL = """
select 'dohmh_nyc' as source, cast(l_partkey as varchar) as source_id, trim(p_name) as name, street || 'QUEENS, NY 11101' as address, 407e-1 as lat, case when l_partkey % 7 > 0 then -739e-1 end as lng, 'open' as state, max(visit) as date
from raw where l_returnflag <> 'A' group by all having max(visit) > date '2000-01-01'
union all
select case l_returnflag when 'R' then 'cdph_chicago_oob' else 'cdph_chicago' end, cast(l_partkey as varchar), trim(sign), street || 'CHICAGO, IL 60601', 419e-1, -876e-1, case l_returnflag when 'R' then 'closed' else 'open' end, visit
from (select * from visits qualify row_number() over (partition by l_partkey order by visit desc, no) = 1)
union all
select 'cpa_tx', l_orderkey || '-' || l_linenumber, trim(p_name), street || 'WACO, TX 767' || lpad(cast(l_partkey % 100 as varchar), 2, '0'), null, null, 'open', date '2001-10-01'
from raw where l_suppkey % 4 in (0, 2) and l_returnflag <> 'R'
union all
select 'dmv_ny', cast(l_partkey as varchar), trim(p_name || ' ' || p_brand), street || 'Troy, NY 12180', case when l_partkey % 3 > 0 then 427e-1 end, case when l_partkey % 3 > 0 then -736e-1 end, 'open', date '2001-11-05'
from (select * from garages qualify row_number() over (partition by l_partkey order by strftime(expires, '%m/%d/%Y'), street) = 1)"""


@q("reg_13_register_specifications", f"with {_SPECS} {_SPECS_SQL}")
def _(d: Data):
    landed = {s: _raw(d).select(F.expr(f"struct({e})").alias("r")).select("r.*") for s, e in _LANDED.items()}
    return register_specs.evidence_of(landed, _TODAY, {"cpa_tx": date(2001, 10, 1)})


_HALF = lambda h: f"select case when id % 5 = 0 and half = 'cur' and id % 3 > 0 then 'x' else event end as source, cast(id as string) as source_id, status as state from (select *, 's' || cast(id % 5 as string) as event from fx_snap) s where half = '{h}'"
_HALF_SQL = lambda h: _HALF(h).replace("as string", "as varchar")
_CNT = f"nw as (select source, count(*) as now from ({_HALF_SQL('cur')}) group by 1), bf as (select source, count(*) as before from ({_HALF_SQL('prev')}) group by 1)"
q("reg_11_plausibility_gate", Q.query("select bf.source, coalesce(now, 0) as rows, before, coalesce(now, 0) >= 5e-1 * before as ok from bf left join nw using (source)", _CNT))(lambda d: registers.plausible(d.view(_HALF("cur")), d.view(_HALF("prev"))))
_ANS = "select distinct address, case when cast(substr(address, 1, 3) as int) % 2 = 0 then lat end as lat, case when cast(substr(address, 1, 3) as int) % 2 = 0 then lng end as lng from (select address, min(lat) as lat, min(lng) as lng from fx_register where lat is not null group by address) g where cast(substr(address, 1, 3) as int) % 5 <> 0"
q("join_27_apply_geocodes", Q.query(f"select r.source, r.source_id, r.date, coalesce(r.lat, a.lat) as lat, coalesce(r.lng, a.lng) as lng from reg_n r left join ({_ANS}) a on a.address = r.address and a.lat is not null", Q.REG_N))(lambda d: registers.apply_geocodes(d.register(), d.view(_ANS)).select("source", "source_id", "date", "lat", "lng"))
_ANS2 = "select address, max(lat) as lat, max(lng) as lng from fx_register where lat is not null group by address having count(*) % 2 = 0"
q("join_28_geocode_todo", Q.query(f"select distinct address from reg_n where lat is null and regexp_matches(address, '^[0-9]+ .+, .+, [A-Z]{{2}} [0-9]{{5}}') and address not in (select address from ({_ANS2}))", Q.REG_N))(lambda d: registers.geocode_todo(d.register(), d.view(_ANS2)))
q("join_29_merge_geocodes", Q.query(f"select address, arg_max(lat, k) filter (where k = m) as lat, arg_max(lng, k) filter (where k = m) as lng from (select *, max(k) over (partition by address) as m from (select *, 0 as k from ({_ANS}) union all select *, 1 as k from ({_ANS2}))) group by address"))(lambda d: registers.merge_answers(d.view(_ANS), d.view(_ANS2)))

# --- monitoring and reports --------------------------------------------------------------------------------------
_NOTE = "case when before = 0 then 'new' when now < 5e-1 * before then 'check' when abs(now - before) > 2e-1 * before then 'moved' else 'ok' end"
_WATCH = f"watch as (select *, {_NOTE} as note from (select coalesce(b.source, n.source) as source, coalesce(before, 0) as before, coalesce(now, 0) as now from bf b full outer join nw n on n.source = b.source))"
_cur, _prev = (lambda d: d.view(_HALF("cur"))), (lambda d: d.view(_HALF("prev")))
_watch = lambda d: monitor.source_watch(_prev(d), _cur(d))
q("mon_01_source_watch", Q.query("select * from watch", _CNT, _WATCH))(_watch)
q("mon_02_keep_previous", Q.query(f"select * from ({_HALF_SQL('cur')}) where source not in (select source from watch where note = 'check') union all select * from ({_HALF_SQL('prev')}) where source in (select source from watch where note = 'check')", _CNT, _WATCH))(lambda d: monitor.keep_previous(_prev(d), _cur(d), _watch(d)))
_GONE = f"gone as (select source, source_id from ({_HALF_SQL('prev')}) p where state = 'open' and not exists (select 1 from ({_HALF_SQL('cur')}) c where c.source = p.source and c.source_id = p.source_id))"
_FINE = f"select g.source, g.source_id from gone g where g.source in (select source from watch where note <> 'check') and (select count(*) from gone x where x.source = g.source) <= 2e-1 * (select count(*) from ({_HALF_SQL('prev')}) y where y.source = g.source and y.state = 'open')"
q("mon_03_vanished", Q.query(_FINE, _CNT, _WATCH, _GONE))(lambda d: monitor.vanished(_prev(d), _cur(d), _watch(d)))
q("mon_04_hold_vanished", Q.query("select source, source_id, min(missed) as missed from (select source, source_id, date '2001-11-05' as missed from gone union all select source, source_id, date '2001-10-05' from gone where length(source_id) % 2 = 0) group by all", _GONE))(
    lambda d: (lambda g: monitor.hold_vanished(g, g.where(F.length("source_id") % 2 == 0).withColumn("missed", F.lit("2001-10-05").cast("date")), _TODAY))(_prev(d).where("state = 'open'").select("source", "source_id").join(_cur(d), ["source", "source_id"], "left_anti")))
q("set_04_key_difference", Q.query(f"select distinct source, source_id from ({_HALF_SQL('prev')}) p where not exists (select 1 from ({_HALF_SQL('cur')}) c where c.source = p.source and c.source_id = p.source_id)"))(lambda d: monitor.key_difference(_prev(d), _cur(d), ["source", "source_id"]))
_PL = f"pl as (select b.id, case when dataset_no = 1 then 'bar' when dataset_no = 2 then 'fast_food_restaurant' else category end as category, region, coalesce(s.status, 'unknown') as status, (select count(*) from fx_evidence e where e.place_id = b.id) as n_evidence, s.status_source, b.operating_status from fx_base b left join ({_ST}) s on s.place_id = b.id)"


def _places(d: Data) -> DataFrame:
    n = d.evidence().groupBy("place_id").agg(F.count(F.lit(1)).alias("n"))
    st = d.status().select(c("place_id").alias("_p"), c("status").alias("_s"), "status_source")
    cat = F.when(c("dataset_no") == 1, "bar").when(c("dataset_no") == 2, "fast_food_restaurant").otherwise(c("category"))
    df = d.base().join(st, c("id") == c("_p"), "left").join(n, c("id") == c("place_id"), "left")
    return df.select("id", cat.alias("category"), "region", F.coalesce("_s", F.lit("unknown")).alias("status"), F.coalesce("n", F.lit(0)).alias("n_evidence"), "status_source", "operating_status")


_B = Q.case_of("category", categories.BUCKETS, "'everything else'")
q("agg_10_coverage_by_bucket", Q.query(f"select {_B} as category, count(*) as listed, {Q.rnd("100e0 * count(*) filter (where status <> 'unknown') / count(*)", 1)} as pct_with_status, count(*) filter (where status = 'open') as open, count(*) filter (where status = 'closed') as closed, {Q.rnd('100e0 * count(*) filter (where n_evidence > 0) / count(*)', 1)} as pct_any_evidence from pl group by 1", _PL))(lambda d: report.coverage_by_bucket(_places(d)))
_CELLS = f"cells as (select region as state, {_B} as category, count(*) as listed, {Q.rnd("100e0 * count(*) filter (where status <> 'unknown') / count(*)", 1)} as pct from pl group by 1, 2)"
q("agg_11_coverage_by_state", Q.query(f"select state, cast(sum(listed) as bigint) as listed, {Q.rnd('sum(pct * listed) / sum(listed)', 1)} as pct from cells group by 1", _PL, _CELLS))(lambda d: report.coverage_by_state(_places(d))[1])
_BN = ["bars", "fast food", "everything else"]
q("rep_09_coverage_pivot", Q.query("select state, " + ", ".join(f"max(pct) filter (where category = '{b}') as \"{b}\"" for b in _BN) + " from cells group by 1", _PL, _CELLS))(lambda d: report.coverage_pivot(report.coverage_by_state(_places(d))[0], _BN))
q("rep_10_coverage_bins", Q.query("select state, category, case when pct < 5 then 0 when pct < 15 then 1 when pct < 30 then 2 when pct < 45 then 3 when pct < 60 then 4 else 5 end as bin from cells", _PL, _CELLS))(lambda d: report.coverage_by_state(_places(d))[0].select("state", "category", report.coverage_bin(c("pct")).alias("bin")))
q("agg_12_evidence_by_rule", Q.query("select source, state, rule, count(*) as rows, count(distinct place_id) as places from fx_evidence group by all"))(lambda d: report.evidence_by_rule(d.evidence()))
q("agg_13_distinct_dedupe", Q.query("select place_id, array_to_string(list_sort(list(distinct source)), ',') as sources from fx_evidence group by 1"))(lambda d: d.evidence().select("place_id", "source").distinct().groupBy("place_id").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources")))
q("join_25_register_hit_rate", Q.query("select r.source, r.state, count(*) as records, count(*) filter (where exists (select 1 from ev e where e.source = r.source and e.source_id = r.source_id)) as matched from reg_n r group by all", Q.BASE_N, Q.REG_N, Q.EV))(lambda d: report.hit_rate(d.register(), match.attach_evidence(d.base(), d.register())))
_IND = "select c.source, count(*) as places, count(*) filter (where exists (select 1 from fx_ev2 e where e.place_id = c.place_id and e.state = 'open' and e.date > c.d and e.fam <> c.fam)) as says_open_after, count(*) filter (where exists (select 1 from fx_ev2 e where e.place_id = c.place_id and e.state = 'closed' and e.fam <> c.fam)) as says_closed_too from (select place_id, source, fam, max(date) as d from fx_ev2 where state = 'closed' group by all) c group by 1"
q("join_26_independent_check", Q.query(_IND, "fx_ev2 as (select *, split_part(source, '_', 1) as fam from fx_evidence)"))(lambda d: report.independent_check(d.evidence()))
q("rep_01_places_in", Q.query("select (select count(*) from fx_base) as base, (select count(*) from fx_chain) as chain, (select count(*) from fx_chain where length(id) % 3 = 0) as closed_features"))(
    lambda d: d.view("select (select count(*) from fx_base) as base, (select count(*) from fx_chain) as chain, (select count(*) from fx_chain where length(id) % 3 = 0) as closed_features"))
q("rep_02_merged_by_rule", Q.query("select 'duplicates' as step, 'number, same name' as rule, count(*) as rows from canon where id <> place_id union all select 'chain', rule, count(*) from best group by rule", Q.BASE_N, Q.CHAIN_N, Q.P_CHAIN, Q.B_CHAIN, Q.DUPES, Q.CANON))(
    lambda d: canon.canonical_ids(d.base(), match.self_match(d.base())).where("id <> place_id").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("duplicates").alias("step"), F.lit("number, same name").alias("rule"), "rows")
    .unionByName(report.count_by(match.best_match(d.pairs()), "rule", name="rows").withColumn("step", F.lit("chain"))))
q("rep_03_places_out", Q.query("select (select count(*) from base_n) + (select count(*) from chain_n where id not in (select b_id from best)) as core, (select count(*) from chain_n where id not in (select b_id from best)) as chain_only", *_CH))(
    lambda d: match.unmatched(d.chain(), match.best_match(d.pairs())).agg(F.count(F.lit(1)).alias("chain_only")).withColumn("n", F.lit(d.base().count())).select((c("n") + c("chain_only")).alias("core"), "chain_only"))
q("rep_04_minted_by_source", Q.query("select source, count(*) as places from born group by 1", *_M, _LOOK, _BORN))(lambda d: report.count_by(_born(d), "source"))
q("rep_05_status_counts", Q.query("select status, count(*) as places from pl group by 1", _PL))(lambda d: report.count_by(_places(d), "status"))
q("rep_06_decided_by", Q.query("select status, status_source, count(*) as places from pl where status <> 'unknown' group by all", _PL))(lambda d: report.count_by(_places(d).where("status <> 'unknown'"), "status", "status_source"))
q("rep_07_external_status_cross", Q.query("select coalesce(operating_status, '(none)') as overture_status, status, count(*) as places from pl group by all", _PL))(lambda d: report.count_by(_places(d), F.coalesce("operating_status", F.lit("(none)")).alias("overture_status"), "status"))
_SEEN = "select 'g' || lpad(cast(n as string), 7, '0') as id, case when n % 3 = 0 then 'closed' else 'open' end as says from fx_b where n % 2 = 0"
q("rep_11_score_calibration", Q.query(f"select cast(floor({Q.rnd(_SCORE_SQL, 2)} * 10 + 1e-9) as int) as band, count(*) as places, count(*) filter (where says = 'open') as open, count(*) filter (where says = 'closed') as closed from fx_base b left join st s on s.place_id = b.id join ({_SEEN.replace('as string', 'as varchar')}) n on n.id = b.id group by 1", f"st as ({_ST})"))(
    lambda d: report.score_calibration(QUERIES["fn_26_open_score"](d.spark, d.sf_dir), d.view(_SEEN)))
q("rep_12_layer_separation", Q.query("select place_id as id, 'source' as why from members where starts_with(source, 'osm') union all select distinct place_id, 'license' from allm where starts_with(source, 'osm')", *_CH, _MEMBERS.replace("'atp'", "case when length(n.id) % 2 = 0 then 'osm' else 'atp' end"), _ALLM))(
    lambda d: (lambda m: report.layer_violations(m, score.member_rollup(m).select(c("place_id").alias("id"), c("member_licenses").alias("licenses"))))(
        _all_members(d).withColumn("source", F.when((c("source") == "atp") & (F.length("source_id") % 2 == 0), "osm").otherwise(c("source")))))
q("sort_01_review_sample_merge", Q.query("select a_id, b_id, rule from best where rule = 'number' order by md5(b_id), b_id limit 40", *_CH))(
    lambda d: report.review_sample(match.best_match(d.pairs()).where("rule = 'number'").select("a_id", "b_id", "rule"), "b_id"))
q("sort_02_review_sample_evidence", Q.query("select place_id, source_id, date from (select distinct place_id, source_id, date, place_id || source_id || cast(date as varchar) as k from fx_evidence where source = 'alpha_x' and state = 'closed' and rule = 'number') order by md5(k), k limit 40"))(
    lambda d: report.review_sample(d.evidence().where("source = 'alpha_x' and state = 'closed' and rule = 'number'").select("place_id", "source_id", "date", F.concat("place_id", "source_id", c("date").cast("string")).alias("k")).distinct(), "k").drop("k"))

# --- sets --------------------------------------------------------------------------------------------------------
q("set_01_union_layers", Q.query("select place_id, source, source_id from allm", *_CH, _MEMBERS, _ALLM))(_all_members)
q("set_03_delete_rows", ORACLES["flt_06_independents_only"])(lambda d: evidence.independents_only(match.attach_evidence(d.base(), d.register()), d.base(), ("out_cancelled",)))

# --- sources -----------------------------------------------------------------------------------------------------


@q("src_01_scan_box_parquet", Q.query("select id, name, lat, lng from fx_base where name is not null and lat between 3885e-2 and 3895e-2 and lng between -7705e-2 and -7695e-2 and region = 'DC'"))
def _(d: Data):
    path = d.folder()
    d.view("select id, name, lat, lng, region as country from fx_base").write.parquet(path)
    return scan.scan_box_parquet(d.spark, path, _BOX, "DC").drop("country")


@q("src_02_flatten_base", Q.query("select id, name, category, brand, address, region, postcode, fsq_id, lat, lng from fx_base"))
def _(d: Data):
    b = d.view("select * from fx_base")
    named = lambda x: F.struct(c(x).alias("primary"))
    nested = b.select("id", named("name").alias("names"), F.struct(c("category").alias("primary"), F.array("category").alias("hierarchy")).alias("taxonomy"), F.struct(named("brand").alias("names"), F.lit("x").alias("wikidata")).alias("brand"),
        F.array(F.struct(c("address").alias("freeform"), F.lit(None).cast("string").alias("locality"), "region", "postcode")).alias("addresses"), F.array().cast("array<string>").alias("phones"), F.array().cast("array<string>").alias("websites"),
        F.lit(0.5).alias("confidence"), "operating_status", F.array(F.struct(F.lit("meta").alias("dataset"), F.lit("m").alias("record_id")), F.struct(F.lit("Foursquare").alias("dataset"), c("fsq_id").alias("record_id"))).alias("sources"), F.struct(c("lat").alias("ymin"), c("lng").alias("xmin")).alias("bbox"))
    return scan.flatten_base(nested).select("id", "name", "category", "brand", "address", "region", "postcode", "fsq_id", "lat", "lng")


@q("src_03_scan_geojson_lines", Q.query("select 'chain/' || id as atp_id, name, 'shop=' || category as category, housenumber || ' N Main St' as address, lat, lng from fx_chain where lat between 3885e-2 and 3895e-2 and lng between -7705e-2 and -7695e-2 and housenumber is not null and category is not null"))
def _(d: Data):
    ch = d.view("select * from fx_chain where housenumber is not null and category is not null")
    props = F.create_map(F.lit("@spider"), F.lit("chain"), F.lit("ref"), c("id"), F.lit("name"), c("name"), F.lit("shop"), c("category"), F.lit("addr:housenumber"), c("housenumber"), F.lit("addr:street"), F.lit("N Main St"))
    line = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(props), F.lit(',"geometry":{"type":"Point","coordinates":['), c("lng").cast("string"), F.lit(","), c("lat").cast("string"), F.lit("]}}"))
    path = d.folder()
    ch.select(line.alias("value")).write.text(path)
    return scan.parse_chain_features(d.spark.read.text(path), _BOX).select("atp_id", "name", "category", "address", "lat", "lng")


def _tagged(d: Data) -> DataFrame:
    n = c("p_partkey")
    tags = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in {
        "name": F.when(n % 4 != 0, c("p_name")), "old_name": F.when(n % 8 == 0, F.lit("old")), "amenity": F.when(n % 3 == 0, F.lit("cafe")), "shop": F.when(n % 3 == 1, F.when(n % 2 == 0, "yes").otherwise("books")), "disused:shop": F.when(n % 3 == 2, F.lit("shoes")),
        "addr:housenumber": n.cast("string"), "contact:phone": F.when(n % 2 == 0, F.lit("1")), "phone": F.when(n % 4 == 0, F.lit("2")), "survey:date": F.lit("2001-01-01")}.items()]), lambda e: e["v"].isNotNull()))
    return d.table("part").select(c("p_partkey").alias("osm_id"), tags.alias("tags"))


_TAG_SQL = """select osm_id, name, category, lifecycle from (select p_partkey as osm_id, coalesce(case when p_partkey % 4 <> 0 then p_name end, case when p_partkey % 3 = 2 and p_partkey % 8 = 0 then 'old' end) as name,
  case p_partkey % 3 when 0 then 'amenity=cafe' when 1 then case when p_partkey % 2 = 0 then 'shop=yes' else 'shop=books' end else 'shop=shoes' end as category, case when p_partkey % 3 = 2 then 'disused' end as lifecycle from part) where name is not null and category <> 'shop=yes'"""
q("src_04_classify_tags", _TAG_SQL)(lambda d: scan.classify_tags(_tagged(d)).select("osm_id", "name", "category", "lifecycle"))
q("src_05_project_tags", "select p_partkey as osm_id, cast(p_partkey as varchar) as housenumber, case when p_partkey % 4 = 0 then '2' when p_partkey % 2 = 0 then '1' end as phone, '2001-01-01' as check_date from part")(lambda d: scan.project_tags(_tagged(d)).select("osm_id", "housenumber", "phone", "check_date"))


_PLACED = "cast(-7705e-2 as double) + (p_partkey % 100) * 1e-3 as x0, cast(3885e-2 as double) + (p_partkey % 97) * 2e-3 as y0"


@q("src_06_scan_ndjson_features", Q.query(f"""select osm_id, edited, name, {Q.rnd('x', 6)} as lng, {Q.rnd('y', 6)} as lat
  from (select cast(p_partkey % 500 as varchar) as osm_id, cast(to_timestamp(p_size * 86400 * 100) as date) as edited, p_name as name, p_size, p_brand, x0 + cx as x, y0 + cy as y from (select *, {_PLACED} from part) join middles on kind = p_partkey % {len(KINDS)})
  where x between -771e-1 and -769e-1 and y between 388e-1 and 390e-1 qualify row_number() over (partition by osm_id order by p_size desc, name, p_brand) = 1""", _middles_sql()))  # fmt: skip
def _(d: Data):
    path = d.folder()
    rows = d.table("part").withColumns({"x0": F.lit(-77.05) + (c("p_partkey") % 100) * 1e-3, "y0": F.lit(38.85) + (c("p_partkey") % 97) * 2e-3})
    line = F.concat(F.lit('{"osm_id":"'), (c("p_partkey") % 500).cast("string"), F.lit('","edited":'), (c("p_size").cast("long") * 8_640_000).cast("string"), F.lit(',"name":"'), c("p_name"), F.lit('","category":"'), c("p_brand"), F.lit('","geometry":'), _geometry(c("p_partkey") % len(KINDS), c("x0"), c("y0")), F.lit("}"))
    rows.select(line.alias("value")).write.text(path)
    found = scan.scan_features(d.spark, path, fixtures.BOX)
    return found.select("osm_id", "edited", "name", geo.round_to(c("lng"), 6).alias("lng"), geo.round_to(c("lat"), 6).alias("lat"))


q("win_02_newest_edit", "select cast(p_partkey % 500 as varchar) as osm_id, p_size as edited, p_name as name from part qualify row_number() over (partition by p_partkey % 500 order by p_size desc, p_name, p_brand) = 1")(
    lambda d: scan.newest_edit(d.table("part").select((c("p_partkey") % 500).cast("string").alias("osm_id"), c("p_size").alias("edited"), c("p_name").alias("name"), c("p_brand").alias("category"))).drop("category"))
q("win_04_dedupe_exact", "select distinct l_partkey, l_suppkey, l_linenumber from lineitem")(lambda d: scan.dedupe_exact(d.table("lineitem").select("l_partkey", "l_suppkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_linenumber")))
_REG8 = "source, source_id, name, address, lat, lng, state, date"


@q("src_07_scan_evidence_csv", Q.query(f"select {_REG8} from fx_register"))
def _(d: Data):
    path = d.folder()
    d.view(f"select {_REG8} from fx_register").write.option("header", True).option("escape", '"').csv(path)
    return scan.scan_evidence(d.spark, path)


@q("src_08_union_evidence_formats", Q.query("select source, source_id, state, date from fx_register where state = 'open' union all select source, source_id, state, date from fx_register where state = 'closed'"))
def _(d: Data):
    rows = d.view(f"select {_REG8} from fx_register")
    return scan.union_evidence(d.spark, rows.where("state = 'open'"), rows.where("state = 'closed'").drop("name")).select("source", "source_id", "state", "date")


@q("src_09_optional_source", Q.query(f"select {_REG8} from fx_register"))
def _(d: Data):
    gone = scan.optional(d.spark, d.folder(), evidence.EVIDENCE)
    return d.view(f"select {_REG8} from fx_register").unionByName(gone)


q("src_10_backfill_columns", Q.query("select id, name, cast(null as varchar) as phone, cast(null as double) as confidence from fx_base"))(lambda d: publish.ensure_columns(d.view("select id, name from fx_base"), d.spark.createDataFrame([], "id string, phone string, confidence double").schema))


@q("src_11_scan_with_region", Q.query("select half as region, id, status from fx_snap"))
def _(d: Data):
    path = d.folder()
    for half in ("prev", "cur"):
        d.snap(half).write.parquet(f"{path}/status-{half}.parquet")
    return scan.scan_snapshot(d.spark, f"{path}/status-*.parquet").select("region", "id", "status")


@q("src_12_scan_lenient_csv", "select cast(p_partkey as varchar) as p_partkey, p_name, cast(p_size as varchar) as p_size from part")
def _(d: Data):
    path = d.folder()
    d.table("part").select("p_partkey", "p_name", "p_size").write.option("header", True).csv(path)
    return scan.scan_strings(d.spark, path)


@q("src_13_scan_register_text", "select cast(p_partkey as varchar) as id, p_name as name, case when p_partkey % 10 > 0 then p_brand end as brand, case when p_partkey % 10 = 1 then 'more|and more' end as rest, case when p_partkey % 2 = 0 then 'List of even' else '' end as preamble from part")
def _(d: Data):
    """Two lists with columns in another order, one under a preamble, with short rows and rows with too many fields."""
    path, p = d.folder(), d.table("part")
    n = c("p_partkey")
    last = F.when(n % 10 == 0, F.lit("")).when(n % 10 == 1, F.concat(F.lit("|"), c("p_brand"), F.lit("|more|and more"))).otherwise(F.concat(F.lit("|"), c("p_brand")))
    for half, head, line in ((0, ["List of even", "Id | Name|Brand"], F.concat(n.cast("string"), F.lit(" | "), c("p_name"), last)), (1, ["Name|Id|Brand"], F.concat(c("p_name"), F.lit("|"), n.cast("string"), last))):
        lines = d.spark.createDataFrame([(i - 9, x) for i, x in enumerate(head)], "i long, value string").unionByName(p.where(n % 2 == half).select(n.cast("long").alias("i"), line.alias("value")))
        lines.repartition(1).sortWithinPartitions("i").select("value").write.text(f"{path}/half-{half}")
    spec = scan.FileSpec(columns=["Id", "Name", "Brand"], sep="|", quote="", trim=True, skip_until=r"\bId\b")
    return scan.scan_register_text(d.spark, path, spec).select(c("Id").alias("id"), c("Name").alias("name"), c("Brand").alias("brand"), c("_rest").alias("rest"), c("_preamble").alias("preamble"))


@q("src_14_explode_feature_pages", "select p_partkey as id, p_name as name, cast(p_size as double) as x from part")
def _(d: Data):
    page = d.table("part").select((c("p_partkey") % 50).alias("page"), F.struct(F.struct(c("p_partkey").alias("id"), c("p_name").alias("name")).alias("attributes"), F.struct(c("p_size").cast("double").alias("x")).alias("geometry")).alias("f")).groupBy("page").agg(F.to_json(F.struct(F.collect_list("f").alias("features"))).alias("value"))
    schema = "features array<struct<attributes:struct<id:long,name:string>,geometry:struct<x:double>>>"
    return scan.explode_pages(page, schema, c("page.features")).select("attributes.id", "attributes.name", "geometry.x")


_PT = lambda: F.when(c("dataset_no") == 0, F.concat(F.lit("("), "lat", F.lit(", "), "lng", F.lit(")"))).when(c("dataset_no") == 1, F.concat(F.lit('{"type":"Point","coordinates":['), "lng", F.lit(","), "lat", F.lit("]}"))).when(c("dataset_no") == 2, F.lit("(0.0, 0)"))
expr("src_15_point_of", "fx_base", lambda: {"id": c("id"), "lat": scan.point_of(_PT(), "lat"), "lng": scan.point_of(_PT(), "lng")}, {"id": "id", "lat": "case when dataset_no < 2 then lat end", "lng": "case when dataset_no < 2 then lng end"})
_ROWS_SQL = r"""select page_id, cast(r.i - 1 as int) as "row", array_to_string(list_transform(regexp_extract_all(r.v, '(?s)<li>(.*?)</li>', 1), lambda x: replace(replace(replace(replace(replace(replace(trim(regexp_replace(x, '<[^>]*>', '', 'g')), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')), '|') as cells
  from (select page_id, unnest(list_transform(regexp_extract_all(html, '(?s)<ul>(.*?)</ul>', 1), lambda v, i: {'v': v, 'i': i})) as r from pages)"""
q("src_16_extract_html_rows", _ROWS_SQL)(lambda d: scan.extract_html_rows(d.table("pages"), r"(?s)<ul>(.*?)</ul>", r"(?s)<li>(.*?)</li>", keep=("page_id",)).select("page_id", "row", F.array_join("cells", "|").alias("cells")))
_OD = lambda: F.to_date("o_orderdate")
expr("src_17_as_of_date", "", lambda: {"o_orderkey": c("o_orderkey"), "month_end": scan.as_of("month_end", _OD()), "school": scan.as_of("school_year", F.date_format(_OD(), "yyyy")), "tag": scan.as_of("file_tag", F.concat(F.lit("list_"), F.date_format(_OD(), "yyyyMMdd"), F.lit(".csv"))), "url": scan.as_of("month_in_url", F.concat(F.lit("/files/20"), F.date_format(_OD(), "yy-MM"), F.lit("/x")))},
     {"o_orderkey": "o_orderkey", "month_end": "last_day(o_orderdate)", "school": "make_date(year(o_orderdate) + 1, 6, 30)", "tag": "cast(o_orderdate as date)", "url": "make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), 1)"}, table="orders")
_EST_SQL = "select o_orderkey, case when o_orderkey % 3 = 0 then o_orderpriority when o_orderkey % 3 = 1 then 'usual' else case when c_custkey % 4 > 0 then c_name end end as name from orders join customer on c_custkey = o_custkey where o_orderkey % 7 > 0 and not (o_orderkey % 3 = 2 and c_custkey % 4 = 0)"


@q("src_18_register_join_units", _EST_SQL)
def _(d: Data):
    n = c("o_orderkey")
    est = d.table("orders").select("o_orderkey", c("o_custkey").alias("siren"), F.when(n % 3 == 0, c("o_orderpriority")).otherwise(" ").alias("sign"), F.when(n % 3 == 1, "usual").alias("usual_name"), F.when(n % 7 > 0, F.to_date("o_orderdate")).alias("day"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    units = d.table("customer").select(c("c_custkey").alias("siren"), c("c_name").alias("company"), (c("c_custkey") % 4 == 0).alias("natural_person"))
    return scan.establishments(est, units).select("o_orderkey", "name")


@q("join_31_bucketed_places", Q.query(f"select b.id, b.name, coalesce(m.n, 0) as members, coalesce(s.status, 'unknown') as status, s.status_date from fx_base b left join (select place_id, count(*) as n from members group by 1) m on m.place_id = b.id left join ({Q.status('fx_evidence')}) s on s.place_id = b.id", *_CH, _MEMBERS))
def _(d: Data):
    chain, params = d.chain(), build.Params(BUILD)
    member = match.members(chain, match.best_match(d.pairs()), "atp")
    layer = build.stored_by_place(build.Layer(d.view("select * from fx_base"), member, d.evidence(), None, None, None), params)
    return build.summary_by_place(layer)


# --- whole builds ------------------------------------------------------------------------------------------------
_FLAG = f"select status, status_source, count(*) as places, count(*) filter (where conflict) as conflicts, max(status_date) as newest from ({Q.status('ev')}) group by all"


@q("flagship_status", Q.query(_FLAG, Q.BASE_N, Q.REG_N, Q.EV))
def flagship(d: Data):
    return build.flagship(build.Inputs(d.view("select * from fx_base"), d.chain(), d.register().select(*_REG8.split(", "))), build.Params(BUILD))


_INDEPENDENT = ", ".join(f"'{x}'" for x in evidence.INDEPENDENTS_ONLY)
#: The core layer in SQL: duplicates merged, chain rows joined or added, evidence attached, places minted.
_CORE = (
    *_CANON, Q.CHAIN_N, Q.REG_N, _FSQ,
    f"kept as (select b.* replace (m.category as category, m.brand as brand, m.postcode as postcode, m.operating_status as operating_status) from base_n b join ({_MERGE}) m on m.id = b.id)",
    f"cp as ({Q.pairs('kept', 'chain_n')})", f"cbest as ({Q.best('cp')})",
    "cfill as (select a_id, hn from cbest join chain_n on id = b_id qualify row_number() over (partition by a_id order by dist, b_id) = 1)",
    f"place as (select k.id, k.name, k.category, k.brand, k.nn, coalesce(k.hn, nullif(f.hn, '')) as hn, {Q.zip5('k.postcode')} as zip, k.sk, k.lat, k.lng from kept k left join cfill f on f.a_id = k.id union all select id, name, category, null, nn, hn, null, null, lat, lng from chain_n where id not in (select b_id from cbest))",
    "cmember as (select coalesce(b.a_id, n.id) as place_id, n.id, coalesce(b.rule, 'self') as rule, coalesce(b.dist, 0e0) as dist, n.collected, n.name from chain_n n left join cbest b on b.b_id = n.id)",
    f"found as ({Q.attached('place', 'reg_n')} union all select k.place_id, 'fsq_closed', f.fsq_place_id, 'closed', f.date_closed, 'id', 0e0, f.name, f.address from base_n o join canon k on k.id = o.id join closed f on f.fsq_place_id = o.fsq_id where {Q.passing('(' + Q.sim('f.nn', 'o.nn') + ')')}"
    " union all select place_id, 'atp', id, 'open', collected, rule, dist, name, null from cmember where collected is not null)",
    f"ev as (select * from found f where not (f.source in ({_INDEPENDENT}) and exists (select 1 from place p where p.id = f.place_id and p.brand is not null)))",
    _ELIG, _LOOK.replace("base_n b", "place b"), _BORN,
    f"core_place as (select id, name, category, brand, nn, hn, zip, sk, lat, lng from place union all select place_id, {Q.display('name')}, category, null, nn, hn, zip, sk, lat, lng from born)",
    "core_ev as (select * from ev union all select place_id, source, source_id, state, date, 'self', 0e0, name, address from born)",
)
_BUILT = "select p.id, p.name, p.category, s.status, s.status_date, s.status_source from {place} p left join ({status}) s on s.place_id = p.id"
#: Map features: some lie by listings and join them, others stay alone; tagged, dated and closed in turn.
_FX_FEATURES = """select 'n' || cast(n as string) as id, case when n % 3 = 0 then nm else nm || 's' end as name, case when n % 5 = 0 then null else cast(100 + site % 90 as string) end as housenumber, 'Main St' as street, cast(null as string) as postcode,
  p_type as category, date '2001-04-01' as edited, case when n % 6 = 0 then 'disused' end as lifecycle, case n % 4 when 0 then '2000-05-06' when 1 then '2000' end as end_date, case when n % 3 = 1 then '2001-04-05' end as check_date,
  'Q' || cast(n as string) as wikidata, 388e-1 + ((site * 37) % 200) * 1e-3 + case when n % 7 = 0 then 3e-1 else 1e-4 end as lat, -771e-1 + ((site * 53) % 190) * 1e-3 as lng from fx_b"""
_FX_ITEMS = "select 'Q' || cast(n as string) as qid, date '1998-07-06' as date from fx_b where n % 8 = 0"
_FULL = (
    *_CORE, _HIST,
    f"feat as (select *, {Q.norm('name')} as nn, {Q.house('housenumber')} as hn, concat_ws(' ', housenumber, street) as address from ({_FX_FEATURES.replace('as string', 'as varchar')}))",
    f"fp as ({Q.pairs('core_place', 'feat')})", f"fbest as ({Q.best('fp')})",
    "fmember as (select coalesce(b.a_id, f.id) as place_id, coalesce(b.rule, 'self') as rule, coalesce(b.dist, 0e0) as dist, f.* from feat f left join fbest b on b.b_id = f.id)",
    f"lone as (select id, name, category, nn, hn, cast(null as varchar) as zip, {Q.street('address')} as sk, lat, lng from feat where id not in (select b_id from fbest))",
    f"full_place as (select id, name, category from core_place union all select id, name, category from lone)",
    f"full_ev as (select * from core_ev union all select place_id, 'osm_lifecycle', id, 'closed', coalesce({_DAY('end_date')}, edited), rule, dist, name, address from fmember where lifecycle is not null"
    f" union all select place_id, 'osm_check_date', id, 'open', {_DAY('check_date')}, rule, dist, name, address from fmember where lifecycle is null and {_DAY('check_date')} is not null"
    f" union all select k.place_id, 'osm_history', h.overture_id, 'closed', h.event_date, 'id', 0e0, h.event, null from hist h join base_n o on o.id = h.overture_id join canon k on k.id = o.id where {Q.passing('(' + Q.sim('h.nn', 'o.nn') + ')')} and not (h.event = 'substantial_rename' and h.osm_name is not null and {Q.passing('(' + Q.sim('h.renamed', 'o.nn') + ')')})"
    f" union all select m.place_id, 'wikidata_p576', m.wikidata, 'closed', w.date, m.rule, m.dist, m.name, m.address from fmember m join ({_FX_ITEMS.replace('as string', 'as varchar')}) w on w.qid = m.wikidata where m.category not like 'office=%'"
    f" union all {Q.attached('lone', 'reg_n')})",
)


def _inputs(d: Data) -> build.Inputs:
    return build.Inputs(
        _base_full(d).drop("nn", "hn", "zip", "sk"), d.view("select * from fx_chain"), d.register().select(*_REG8.split(", ")), d.view(_FX_FEATURES), _closed(d), d.view(_HIST_SQL), d.view(_FX_ITEMS)
    )


def _built(layer: build.Layer) -> DataFrame:
    status = layer.status.select(c("place_id").alias("id"), "status", "status_date", "status_source")
    return layer.place.select("id", "name", "category").join(status, "id", "left")


@q("build_region_core", Q.query(_BUILT.format(place="core_place", status=Q.status("core_ev")), *_CORE))
def _(d: Data):
    return _built(build.core_layer(_inputs(d), build.Params(BUILD, storefronts=STOREFRONTS)))


@q("build_region_full", Q.query(_BUILT.format(place="full_place", status=Q.status("full_ev")), *_FULL))
def _(d: Data):
    inputs, params = _inputs(d), build.Params(BUILD, storefronts=STOREFRONTS)
    return _built(build.full_layer(build.core_layer(inputs, params), inputs, params))
