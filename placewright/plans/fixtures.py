"""Place-domain views over the star schema's tables, in SQL that both Spark and DuckDB take: listings with duplicates, chain
rows, register records, attached evidence and two status snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

BUILD, RECENT_DAYS = date(2001, 11, 5), 730
BOX = (38.8, -77.1, 39.0, -76.9)

VIEWS = """
fx_b as (
  select p_partkey as n, cast(floor(p_partkey / 4e0) as int) as site, p_partkey % 4 as slot, p_brand, p_type, p_size,
         p_name || ' ' || lower(p_type) || ' ' || cast(p_size as string) || 'th' as nm
  from {part}),
fx_base as (   -- spine listings; the second branch makes duplicates
  select 'g' || lpad(cast(n as string), 7, '0') as id, nm as name, case when slot = 3 then null else p_type end as category,
         case when n % 6 = 0 then p_brand end as brand,
         case when slot = 3 then 'Main Plaza' else cast(100 + site % 90 as string) || ' N Main St' end as address,
         case site % 3 when 0 then 'DC' when 1 then 'NY' else 'VA' end as region,
         '200' || lpad(cast(site % 20 as string), 2, '0') as postcode,
         case when n % 13 = 0 then 'permanently_closed' when n % 2 = 0 then 'open' end as operating_status,
         'f' || cast(n as string) as fsq_id, n % 4 as dataset_no,
         388e-1 + ((site * 37) % 200) * 1e-3 + slot * 2e-5 as lat, -771e-1 + ((site * 53) % 190) * 1e-3 as lng
  from fx_b
  union all
  select 'h' || lpad(cast(n as string), 7, '0'), upper(nm) || ' LLC', null, null, cast(100 + site % 90 as string) || ' N MAIN ST',
         null, null, 'permanently_closed', null, 3,
         388e-1 + ((site * 37) % 200) * 1e-3 + 8e-4, -771e-1 + ((site * 53) % 190) * 1e-3
  from fx_b where n % 20 = 0),
fx_chain as (  -- rows that join the spine by number / near / spot, or stay alone
  select 'sp' || cast(n % 5 as string) || '/' || cast(n as string) as id,
         case when n % 2 = 0 then 'The ' || nm when n % 7 = 0 then nm || ' and more' else replace(nm, 'e', 'ee') end as name,
         case when n % 9 = 0 then cast(300 + site % 90 as string) when n % 5 = 0 then null
              else cast(100 + site % 90 as string) end as housenumber,
         p_type as category, date '2001-06-01' as collected,
         388e-1 + ((site * 37) % 200) * 1e-3 + slot * 2e-5 + case when n % 9 = 0 then 1e-4 else 3e-4 end as lat,
         -771e-1 + ((site * 53) % 190) * 1e-3 as lng
  from fx_b),
fx_register as (  -- evidence-format rows; no position on every 5th line number, and an unlisted place on every 13th order
  select case l_suppkey % 4 when 0 then 'reg_front' when 1 then 'reg_list' when 2 then 'abca_dc_active' else 'out_cancelled' end as source,
         cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as source_id,
         upper(case when l_orderkey % 13 = 0 then 'unlisted ' || reverse(b.nm) when l_orderkey % 3 = 0 then b.nm || ' LLC' when l_orderkey % 11 = 0 then 'new ' || b.nm else b.nm end) as name,
         cast(100 + site % 90 as string) || ' N MAIN ST, TOWN, DC 200' || lpad(cast(site % 20 as string), 2, '0') as address,
         case when l_linenumber % 5 = 0 then null else 388e-1 + ((site * 37) % 200) * 1e-3 + case when l_orderkey % 13 = 0 then 2e-1 else 2e-4 end end as lat,
         case when l_linenumber % 5 = 0 then null else -771e-1 + ((site * 53) % 190) * 1e-3 end as lng,
         case when l_returnflag = 'R' then 'closed' else 'open' end as state, cast(l_shipdate as date) as date
  from {lineitem} l join fx_b b on b.n = l.l_partkey),
fx_evidence as (  -- already attached evidence, for status / score / stats
  select 'g' || lpad(cast(l_partkey as string), 7, '0') as place_id,
         case l_suppkey % 3 when 0 then 'alpha_x' when 1 then 'alpha_y' else 'beta_z' end as source,
         cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as source_id,
         case when l_returnflag = 'R' then 'closed' else 'open' end as state, cast(l_shipdate as date) as date,
         case l_linenumber % 3 when 0 then 'number' when 1 then 'near' else 'spot' end as rule, cast(l_quantity as double) as dist
  from {lineitem}),
fx_snap as (  -- two snapshots: half = 'prev' / 'cur'; ids dropped from one side on purpose
  select half, id, case event_type when 'error' then 'closed' when 'purchase' then 'open' when 'signup' then 'open' else 'unknown' end as status
  from (select user_id as id, event_type, half,
               row_number() over (partition by user_id, half order by ts desc, event_id desc) as rn
        from (select *, case when cast(ts as date) < date '2024-01-16' then 'prev' else 'cur' end as half from {events}) e) r
  where rn = 1 and not (half = 'prev' and id % 17 = 0) and not (half = 'cur' and id % 13 = 0)),
fx_outline as (  -- a state of as many vertices as parts: a mainland with a lake, an island, and an islet in the lake
  select ring, i, floor((mx + r * cos(t)) * 1e7 + 5e-1) / 1e7 as x, floor((my + r * sin(t)) * 1e7 + 5e-1) / 1e7 as y
  from (select n % 4 as ring, cast(floor(n / 4e0) as int) as i, t, case n % 4 when 2 then -7693e-2 when 0 then -77e0 else -7701e-2 end as mx, case n % 4 when 2 then 3898e-2 when 0 then 389e-1 else 3891e-2 end as my,
               case n % 4 when 0 then 7e-2 * (1e0 + 15e-2 * sin(5e0 * t)) when 1 then 2e-2 when 2 then 15e-3 else 8e-3 end as r
        from (select n, 2e0 * pi() * floor(n / 4e0) / (floor((select count(*) from fx_b) / 4e0) + 1e0) as t from fx_b)))
"""


def cte() -> str:
    """The views for DuckDB, to stand behind WITH."""
    return VIEWS.format(part="part", lineitem="lineitem", events="events").strip()


def view(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """A query over the views, over the tables of a folder."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "lineitem", "events")}
    return spark.sql(f"with {VIEWS} {query}", **tables)
