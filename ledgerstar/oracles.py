"""The results of ``catalogue.py`` as SQL over the same tables, for DuckDB."""

from __future__ import annotations

# What the results must hold is stated here once more, apart from the code that is checked.

# Card tiers with lowest limit, highest limit and step.
CARD_TIERS = {
    "Basic": (1000, 5000, 500),
    "Gold": (5000, 15000, 1000),
    "Platinum": (15000, 30000, 2500),
    "Signature": (30000, 50000, 5000),
    "Infinite": (50000, 100000, 10000),
}

# Card providers.
PROVIDERS = (
    "American Express",
    "Diners Club",
    "Discover",
    "JCB",
    "Maestro",
    "Mastercard",
    "VISA",
)

# The columns of the flat file, of a customer record, and of the tables made.
CUSTOMER = """
first last gender street city state zip lat long city_pop job dob
""".split()
CUSTOMER_KEY = ["cc_num", *CUSTOMER]
CUSTOMER_COLUMNS = [*CUSTOMER, "cust_uuid"]
MERCHANT_COLUMNS = "merchant merch_lat merch_long merch_uuid".split()
CARD_COLUMNS = """
cc_num card_provider card_category expiration_date issue_date credit_limit
""".split()
RAW_COLUMNS = """
trans_date_trans_time cc_num merchant category amt first last gender street city state zip lat
long city_pop job dob trans_num unix_time merch_lat merch_long is_fraud
""".split()
LANDING_COLUMNS = [*RAW_COLUMNS, "merch_uuid", "cust_uuid"]
FACT_COLUMNS = """
trans_num merch_uuid cust_uuid trans_date_trans_time cc_num category amt unix_time is_fraud
""".split()

# The 29 declared tests of the gold layer.
GOLD_TESTS = {
    "dim_card": {
        "not_null": "cc_num card_provider expiration_date issue_date credit_limit is_top_card".split(),
        "unique": ["cc_num"],
    },
    "dim_customer": {
        "not_null": "cust_uuid first last dob age".split(),
        "unique": ["cust_uuid"],
    },
    "dim_merchant": {"not_null": "merch_uuid merchant".split(), "unique": ["merch_uuid"]},
    "fact_transactions": {
        "not_null": """
            trans_num merch_uuid cust_uuid amt is_fraud first last merchant card_provider
            credit_limit
        """.split(),
        "unique": ["trans_num"],
        "relationships": {
            "merch_uuid": ("dim_merchant", "merch_uuid"),
            "cust_uuid": ("dim_customer", "cust_uuid"),
        },
    },
}

AS_OF = "date '2026-01-01'"


def _key(*columns: str) -> str:
    sized = [
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
        for c in columns
    ]
    return (
        f"regexp_replace(md5({' || '.join(sized)}), "
        r"'(.{8})(.{4})(.{4})(.{4})(.{12})', '\1-\2-\3-\4-\5')"
    )


def _draw(key: str, label: str) -> str:
    return f"cast('0x' || substr(md5({key} || ':{label}'), 1, 8) as bigint)"


def _list(columns) -> str:
    return ", ".join(columns)


def _day_parts(ts: str) -> str:
    cuts = (("year", 1, 4), ("month", 6, 2), ("day", 9, 2))
    return _list(f"substr(cast({ts} as varchar), {at}, {n}) as {name}" for name, at, n in cuts)


def _enriched(key: str, source: str) -> str:
    names = list(CARD_TIERS)
    tiers = _list(
        f"('{name}', {low}, {high}, {step})" for name, (low, high, step) in CARD_TIERS.items()
    )
    providers = _list(f"'{name}'" for name in PROVIDERS)
    categories = _list(f"'{name}'" for name in names)
    return f"""
select {key}, card_provider, card_category,
       issue_date + cast((3 + {_draw(key, "years")} % 3) * 365 as integer) as expiration_date,
       issue_date,
       cast(low + step * ({_draw(key, "limit")} % (((high - low) // step) + 1)) as integer)
         as credit_limit
from (select {key},
             ([{providers}])[{_draw(key, "provider")} % {len(PROVIDERS)} + 1] as card_provider,
             ([{categories}])[{_draw(key, "category")} % {len(names)} + 1] as card_category,
             {AS_OF} - cast({_draw(key, "issue")} % 1826 as integer) as issue_date
      from {source}) drawn
join (values {tiers}) tiers(tier, low, high, step) on tier = card_category"""


_CARDS_OF_CUSTOMERS = _enriched(
    "cc_num", "(select c_custkey as cc_num from customer) numbers"
)

_FLAT = """
flat as (
  select o_orderdate as trans_date_trans_time, 4000000000000000 + o_custkey as cc_num,
         'fraud_' || coalesce(s_name, 'unlisted') as merchant, o_orderpriority as category,
         o_totalprice as amt, c_name as first, c_mktsegment as last,
         case when c_nationkey < 12 then 'F' else 'M' end as gender,
         o_custkey || ' Main Street, Unit ' || c_nationkey as street,
         'The "' || c_mktsegment || '" Quarter' as city, 'S' || c_nationkey as state,
         cast(o_custkey % 99000 + 501 as integer) as zip,
         cast(c_nationkey as double) + 0.5 as lat, 0.25 - cast(c_nationkey as double) as long,
         (c_nationkey + 1) * 1000 as city_pop, c_mktsegment as job,
         date '1950-01-01' + cast(o_custkey % 18000 as integer) as dob,
         't' || o_orderkey as trans_num, 1325376000 + o_orderkey as unix_time,
         cast(o_orderkey % 180 - 90 as double) as merch_lat,
         cast(o_orderkey % 360 - 180 as double) as merch_long,
         case when o_orderstatus = 'F' then 1 else 0 end as is_fraud
  from orders
  left join (select l_orderkey, min(l_suppkey) as suppkey from lineitem group by 1) firsts
    on l_orderkey = o_orderkey
  left join supplier on s_suppkey = suppkey
  join customer on c_custkey = o_custkey)"""

_BUILT = f"""{_FLAT},
customers as (select *, {_key(*CUSTOMER_KEY)} as cust_uuid
              from (select distinct {_list(CUSTOMER_KEY)} from flat) records),
merchants as (
  select merchant, merch_lat, merch_long, {_key("merchant")} as merch_uuid
  from (select *, row_number() over (partition by merchant
               order by trans_date_trans_time desc, trans_num) as place from flat) placed
  where place = 1),
cards as ({_enriched("cc_num", "(select distinct cc_num from flat) numbers")}),
facts as (
  select flat.*, merch_uuid, cust_uuid from flat
  left join merchants on merchants.merchant is not distinct from flat.merchant
  left join customers on customers.cc_num is not distinct from flat.cc_num)"""

_GOLD = f"""{_BUILT},
dim_card as (select * replace (cast(cc_num as varchar) as cc_num),
                    card_category in ('Signature', 'Infinite') as is_top_card from cards),
dim_customer as (select * exclude (cc_num), cast(2026 - year(dob) as integer) as age
                 from customers),
dim_merchant as (select * replace (replace(merchant, 'fraud_', ' ') as merchant) from merchants),
silver_fact as (
  select {_list(FACT_COLUMNS)} from (select * replace (cast(cc_num as varchar) as cc_num)
                                     from facts) texts),
fact_transactions as (
  select silver_fact.*, dim_customer.first, dim_customer.last, dim_merchant.merchant,
         card_provider, credit_limit
  from silver_fact
  join dim_card on dim_card.cc_num = silver_fact.cc_num
  join dim_customer on dim_customer.cust_uuid = silver_fact.cust_uuid
  join dim_merchant on dim_merchant.merch_uuid = silver_fact.merch_uuid)"""


def _counted(table: str, column: str, test: str, failures: str) -> str:
    return (
        f"select '{table}' as \"table\", '{column}' as \"column\", '{test}' as test, "
        f"cast(({failures}) as bigint) as failures"
    )


def _test_report(tests: dict) -> str:
    parts = []
    for table, declared in tests.items():
        for c in declared.get("not_null", ()):
            count = f"select count(*) from {table} where {c} is null"
            parts.append(_counted(table, c, "not_null", count))
        for c in declared.get("unique", ()):
            values = f"select {c} from {table} where {c} is not null group by 1 having count(*) > 1"
            parts.append(_counted(table, c, "unique", f"select count(*) from ({values}) r"))
        for c, (parent, p) in declared.get("relationships", {}).items():
            lost = (
                f"select count(*) from {table} child where {c} is not null and not exists "
                f"(select 1 from {parent} parent where parent.{p} = child.{c})"
            )
            parts.append(_counted(table, c, "relationships", lost))
    return " union all ".join(parts)


def _profile(source: str, types: dict[str, str]) -> str:
    return " union all ".join(
        f"select {i} as position, '{name}' as \"column\", '{type_}' as type, "
        f'count(*) as "rows", count(*) - count({name}) as nulls, '
        f'count(distinct {name}) as "distinct" from {source}'
        for i, (name, type_) in enumerate(types.items())
    )


_ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

_TEXTS = """
texts as (
  select cast(c_custkey as varchar) as custkey,
         case when c_nationkey = 5 then null
              when c_nationkey in (3, 7) then 'x' || c_nationkey
              else cast(c_nationkey as varchar) end as nation,
         case when c_mktsegment = 'HOUSEHOLD' then 'n/a'
              else cast(c_acctbal as varchar) end as balance,
         case when c_nationkey = 9 then 'soon' else '1999-12-31' end as since
  from customer)"""
_TEXT_CASTS = """custkey, try_cast(nation as integer) as nation,
         try_cast(balance as double) as balance, try_cast(since as date) as since"""
_SPOILT_TEXT = "(nation like 'x%' or balance = 'n/a' or since = 'soon')"

_IN_CREDIT = "(select * from customer where c_acctbal >= 0)"

ORACLES: dict[str, str] = {
    "star_join": """
select lineitem.*, o_custkey, o_orderdate, o_orderpriority, p_name, p_brand, s_name, c_name,
       c_mktsegment
from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey
join supplier on s_suppkey = l_suppkey join customer on c_custkey = o_custkey""",
    "csv_scan_all_string": """
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
       cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer""",
    "csv_scan_typed": "select * from lineitem",
    "csv_scan_inferred": """
select cast(c_custkey as integer) as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
from customer""",
    "parquet_roundtrip": "select * from part",
    "partitioned_fact": f"select *, {_day_parts('o_orderdate')} from orders",
    "rebalanced_fact": f"select *, {_day_parts('o_orderdate')} from orders",
    "rebalanced_days": f"select *, {_day_parts('o_orderdate')} from orders",
    "partition_pruned_read": f"""
select *, {_day_parts("o_orderdate")} from orders
where o_orderdate >= date '1997-12-01' and o_orderdate < date '1998-01-01'""",
    "day_overwrite": f"""
select * replace (case when o_orderdate >= date '1996-01-01' and o_orderdate < date '1996-02-01'
                       then 0.5 else o_totalprice end as o_totalprice),
       {_day_parts("o_orderdate")} from orders""",
    "incremental_load": """
select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders""",
    "table_from_parquet": "select * from supplier",
    "partitioned_table": """
select *, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       cast(day(o_orderdate) as integer) as day from orders""",
    "bulk_load": "select * from customer",
    "view_materialization": "select p_brand as brand, p_partkey as part_id from part",
    "table_materialization": """
select c_mktsegment, c_nationkey, count(*) as customers from customer group by 1, 2""",
    "drop_columns": "select c_name, c_nationkey, c_mktsegment from customer",
    "project_allowlist": """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
       l_linestatus, l_shipdate from lineitem""",
    "rename_canonical": """
select s_nationkey as nation, s_name as name, s_suppkey as id, s_acctbal as balance
from supplier""",
    "in_list_flag": """
select * replace (nullif(c_mktsegment, 'MACHINERY') as c_mktsegment),
       case when c_mktsegment in ('BUILDING', 'AUTOMOBILE') then true else false end as is_wanted
from customer""",
    "threshold_flag": """
select *, case when c_acctbal >= 5000 then true else false end as is_top from customer""",
    "regex_clean": """
select c_custkey, regexp_replace(c_name, 'Customer#', ' ', 'g') as name from customer""",
    "regex_clean_anchored": """
select c_custkey, substr(c_name, 10) || ' ' || c_name as name from customer""",
    "safe_casts": f"with {_TEXTS} select {_TEXT_CASTS} from texts",
    "cast_quarantine": f"with {_TEXTS} select * from texts where {_SPOILT_TEXT}",
    "cast_survivors": f"""
with {_TEXTS} select {_TEXT_CASTS} from texts
where not coalesce({_SPOILT_TEXT}, false)""",
    "strict_casts": """
select l_orderkey, l_linenumber, l_tax, cast(l_shipdate as date) as l_shipdate
from (select cast(l_orderkey as varchar) as l_orderkey, l_linenumber, l_tax, l_shipdate
      from lineitem) texts""",
    "int_from_float_text": """
select p_partkey, case when p_retailprice = floor(p_retailprice)
                       then cast(p_retailprice as integer) end as whole_price from part""",
    "date_parts": f"select event_id, {_day_parts('ts')} from events",
    "year_boundary_diff": f"""
select o_orderkey, cast(datediff('year', cast(o_orderdate as date), {AS_OF}) as integer) as years
from orders""",
    "date_plus_years": f"""
select o_orderkey, years, cast(o_orderdate as date) + years * 365 as due
from (select *, cast(3 + {_draw("o_orderkey", "years")} % 3 as integer) as years from orders) o""",
    "surrogate_key": f"""
select o_orderkey, {_key("o_custkey", "nullif(o_orderpriority, '5-LOW')", "o_orderdate")} as key
from orders""",
    "card_enrichment": _CARDS_OF_CUSTOMERS,
    "tier_lookup": f"""
select cc_num, card_category, low, high, step from ({_CARDS_OF_CUSTOMERS}) cards
join (values {_list(f"('{n}', {a}, {b}, {c})" for n, (a, b, c) in CARD_TIERS.items())})
  limits(name, low, high, step) on name = card_category""",
    "salted_join": """
with lines as (select * replace (case when l_orderkey % 3 = 0 then 1 else l_suppkey end
                                 as l_suppkey) from lineitem)
select lines.*, s_name from lines join supplier on s_suppkey = l_suppkey""",
    "bucketed_join": """
select lineitem.*, o_orderkey, o_custkey, o_orderdate
from lineitem join orders on o_orderkey = l_orderkey""",
    "pruned_by_join": f"""
select *, {_day_parts("o_orderdate")} from orders where isodow(o_orderdate) = 1""",
    "overlapping_drops": "select * from orders",
    "csv_survivors": "select * from customer where c_custkey % 8 not in (0, 1, 2)",
    "csv_quarantine": """
select concat_ws(',', c_custkey, c_name, c_nationkey,
                 case when c_custkey % 8 = 2 then 'n/a' else cast(c_acctbal as varchar) end,
                 case when c_custkey % 8 <> 0 then c_mktsegment end,
                 case when c_custkey % 8 = 1 then 'more' end) as line
from customer where c_custkey % 8 in (0, 1, 2)""",
    "latest_by_batches": """
select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""",
    "stable_keys": f"""
with moved as (
  select *, case when c_custkey % 5 = 0 then 'MOVED' else c_mktsegment end as now,
         case when c_custkey % 3 <> 0 or c_custkey % 5 <> 0 then c_mktsegment else 'MOVED' end
           as first_seen
  from customer)
select o_orderkey, {_key("c_custkey", "c_name", "first_seen")} as cust_uuid, c_name,
       now as c_mktsegment
from orders join moved on c_custkey = o_custkey""",
    "left_key_attach": f"""
select orders.*, cust_uuid from orders
left join (select c_custkey, {_key("c_custkey")} as cust_uuid from customer
           where c_acctbal >= 0) keyed
  on c_custkey is not distinct from o_custkey""",
    "null_safe_key_attach": f"""
with segments as (select c_custkey, c_nationkey, nullif(c_mktsegment, 'FURNITURE') as segment
                  from customer),
dim as (select distinct segment, c_nationkey from segments)
select c_custkey, segments.segment, {_key("dim.segment", "dim.c_nationkey")} as key
from segments left join dim on dim.segment is not distinct from segments.segment""",
    "aligned_key_join": """
select event_id, cast(user_id as varchar) as user_id, c_name
from events join customer on c_custkey = user_id""",
    "orphan_rows": """
select * from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "orphan_keys": f"""
select o_custkey, count(*) as "rows" from orders
where not exists (select 1 from {_IN_CREDIT} c where c_custkey = o_custkey) group by 1""",
    "orphan_report": f"""
select 'customer' as dimension, count(*) filter (o_orderstatus = 'P') as null_rows,
       count(*) filter (o_orderstatus <> 'P' and not exists
         (select 1 from {_IN_CREDIT} c where c_custkey = o_custkey)) as orphan_rows from orders
union all
select 'lines', 0, count(*) from orders
where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "dedup_rows": "select distinct l_partkey, l_linenumber, l_returnflag from lineitem",
    "concat_by_name": """
select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
union all select s_name, s_acctbal, null from supplier""",
    "concat_dedup": """
select * replace (nullif(o_orderstatus, 'O') as o_orderstatus) from orders""",
    "dimension_extract": "select distinct o_custkey, o_orderpriority from orders",
    "latest_per_key": """
select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""",
    "latest_of_few_keys": """
select * from lineitem
qualify row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey, l_partkey,
  l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "multi_key_sort": "select * from orders order by o_orderpriority, o_orderdate desc",
    "preview": """
select * from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey
limit 20""",
    "null_profile": """
select count(*) filter (c_custkey is null) as c_custkey,
       count(*) filter (c_name is null) as c_name,
       count(*) filter (nullif(c_nationkey, 7) is null) as c_nationkey,
       count(*) filter (c_acctbal is null) as c_acctbal,
       count(*) filter (nullif(c_mktsegment, 'BUILDING') is null) as c_mktsegment from customer""",
    "row_and_distinct_counts": """
select count(*) as "rows", count(distinct (l_orderkey, l_linenumber)) as distinct_rows,
       count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicates from lineitem""",
    "distinct_key_count": "select count(distinct c_mktsegment) as distinct_keys from customer",
    "distinct_values": "select distinct l_returnflag from lineitem",
    "profile_table": _profile(
        "(select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders) o",
        _ORDER_TYPES,
    ),
    "sketched_profile": f"""
select position, "column", type, "rows", nulls, true as close
from ({_profile(
    "(select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders "
    "where year(o_orderdate) in (1995, 1996)) o",
    _ORDER_TYPES,
)}) p""",
    "schema_report": f"""
select position, "column", type, nulls from ({_profile("lineitem", _LINE_TYPES)}) p""",
    "unique_failures": """
select l_orderkey, l_linenumber, count(*) as "rows" from lineitem group by 1, 2
having count(*) > 1""",
    "not_null_tests": """
select 'o_orderkey' as "column", count(*) filter (o_orderkey is null) as failures from orders
union all select 'o_orderpriority', count(*) filter (o_orderpriority = '5-LOW') from orders
union all select 'o_orderdate', count(*) filter (o_orderdate is null) from orders""",
    "observed_not_null": """
select 'o_orderkey' as "column", count(*) filter (o_orderkey is null) as failures from orders
union all select 'o_orderpriority', count(*) filter (o_orderpriority = '5-LOW') from orders
union all select 'o_orderdate', count(*) filter (o_orderdate is null) from orders""",
    "tests_by_day": f"""
with in_credit as {_IN_CREDIT},
spoilt as (select * replace (nullif(o_orderpriority, '5-LOW') as o_orderpriority) from orders)
select 'orders' as "table", "column", test, failures
from ({_test_report({
    "spoilt": {
        "not_null": ["o_orderkey", "o_orderpriority"],
        "unique": ["o_orderkey", "o_custkey"],
        "relationships": {"o_custkey": ("in_credit", "c_custkey")},
    },
})}) report""",
    "data_test_report": f"""
with in_credit as {_IN_CREDIT},
spoilt as (select * replace (nullif(o_orderpriority, '5-LOW') as o_orderpriority) from orders)
select case when "table" = 'spoilt' then 'orders' else "table" end as "table", "column", test,
       failures
from ({_test_report({
    "spoilt": {
        "not_null": ["o_orderkey", "o_orderpriority"],
        "unique": ["o_orderkey", "o_custkey"],
        "relationships": {"o_custkey": ("in_credit", "c_custkey")},
    },
    "in_credit": {"not_null": ["c_name"], "unique": ["c_custkey"]},
})}) report""",
    "flat_files_read": f"with {_FLAT} select {_list(RAW_COLUMNS)} from flat",
    "flat_files_with_line_breaks": f"""
with {_FLAT}
select {_list(RAW_COLUMNS)} from (select * replace (replace(street, ', ', ',' || chr(10) || '"')
                                                    as street) from flat) broken""",
    "build_dim_customer": f"with {_BUILT} select {_list(CUSTOMER_COLUMNS)} from customers",
    "build_dim_merchant": f"with {_BUILT} select {_list(MERCHANT_COLUMNS)} from merchants",
    "build_dim_card": f"with {_BUILT} select {_list(CARD_COLUMNS)} from cards",
    "build_fact": f"with {_BUILT} select {_list(LANDING_COLUMNS)} from facts",
    "build_fact_shared_cards": f"""
with {_FLAT.replace("flat as (", "unpaired as (")},
flat as (select * replace (4000000000000000 + (cc_num - 4000000000000000) // 2 as cc_num)
         from unpaired),
customers as (select *, {_key(*CUSTOMER_KEY)} as cust_uuid
              from (select distinct {_list(CUSTOMER_KEY)} from flat) records),
merchants as (select *, {_key("merchant")} as merch_uuid
              from (select distinct merchant from flat) names)
select {_list(c if c != "cc_num" else "flat.cc_num" for c in FACT_COLUMNS)}
from flat left join merchants on merchants.merchant is not distinct from flat.merchant
left join customers on customers.cc_num is not distinct from flat.cc_num""",
    "bronze_fact": f"""
with {_BUILT} select {_list(LANDING_COLUMNS)}, {_day_parts("trans_date_trans_time")}
from facts""",
    "bronze_dim_customer": f"""
with {_BUILT} select {_list(f"cast({c} as varchar) as {c}" for c in CUSTOMER_COLUMNS)}
from customers""",
    "bronze_dim_merchant": f"""
with {_BUILT} select {_list(f"cast({c} as varchar) as {c}" for c in MERCHANT_COLUMNS)}
from merchants""",
    "bronze_dim_card": f"""
with {_BUILT} select {_list(f"cast({c} as varchar) as {c}" for c in CARD_COLUMNS)} from cards""",
    "silver_dim_card": f"with {_GOLD} select {_list(CARD_COLUMNS)} from dim_card",
    "silver_dim_customer": f"with {_GOLD} select {_list(CUSTOMER_COLUMNS)} from dim_customer",
    "silver_dim_merchant": f"with {_GOLD} select {_list(MERCHANT_COLUMNS)} from dim_merchant",
    "silver_fact": f"with {_GOLD} select * from silver_fact",
    "gold_dim_card": f"with {_GOLD} select * from dim_card",
    "gold_dim_card_by_limit": f"""
with {_GOLD} select * replace (credit_limit >= 10000 as is_top_card) from dim_card""",
    "gold_dim_customer": f"with {_GOLD} select * from dim_customer",
    "gold_dim_merchant": f"with {_GOLD} select * from dim_merchant",
    "bronze_silver_gold": f"with {_GOLD} select * from fact_transactions",
    "daily_rerun": f"""
with {_GOLD} select * replace (
  case when trans_date_trans_time >= timestamp '1996-01-01'
        and trans_date_trans_time < timestamp '1996-02-01' then 0.5 else amt end as amt)
from fact_transactions""",
    "named_gold_fact": f"""
with {_GOLD} select fact_transactions.*, merch_lat
from fact_transactions join dim_merchant using (merch_uuid)""",
    "publish_after_tests": f"with {_GOLD} select * from fact_transactions",
    "named_days": f"""
with {_GOLD} select *, {_day_parts("trans_date_trans_time")} from fact_transactions""",
    "gold_tests": f"with {_GOLD} {_test_report(GOLD_TESTS)}",
    "gold_lost_facts": f"""
with {_GOLD}
select 'dim_card' as dimension, count(*) filter (cc_num is null) as null_rows,
       count(*) filter (cc_num is not null and not exists (
         select 1 from dim_card c where c.cc_num = f.cc_num)) as orphan_rows from silver_fact f
union all
select 'dim_customer', count(*) filter (cust_uuid is null),
       count(*) filter (cust_uuid is not null and not exists (
         select 1 from dim_customer c where c.cust_uuid = f.cust_uuid and c.job <> 'BUILDING'))
from silver_fact f
union all
select 'dim_merchant', count(*) filter (merch_uuid is null),
       count(*) filter (merch_uuid is not null and not exists (
         select 1 from dim_merchant m where m.merch_uuid = f.merch_uuid)) from silver_fact f""",
}
