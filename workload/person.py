"""The person table: two sources of person records derived from every customer.

`crm` holds clean values; `web` the same people with damaged ones, so which records
belong together is known: those whose ids end in the same digits.  Both engines run this
SQL unchanged; Spark takes the customer table as `{customer}`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import normalize as n
from kinweave.plans.rules import Exact, Fuzzy, Rule
from kinweave.schema import Attribute

PERSON_SQL = """
with k as (
  select c_custkey as k,
    split_part('James,Mary,Robert,Linda,Michael,Susan,David,Karen,Thomas,Nancy', ',',
               cast(c_custkey % 10 as int) + 1) as fn,
    split_part('Smith,Johnson,Williams,Brown,Garcia,Miller,Davis,Martinez', ',',
               cast(floor(c_custkey / 10) as int) % 8 + 1) as ln,
    split_part('Oak,Maple,Cedar,Pine,Elm,Birch,Walnut', ',', cast(c_custkey % 7 as int) + 1) as st,
    lpad(cast(c_custkey as varchar(20)), 12, '0') as d,
    lpad(cast(c_custkey % 10000000 as varchar(20)), 7, '0') as p
  from {customer})
select 'crm' as source, concat('A', d) as id, fn as first_name, ln as last_name,
  concat(lower(fn), '.', lower(ln), d, '@example.com') as email,
  concat('+1 (555) ', substr(p, 1, 3), '-', substr(p, 4, 4)) as phone,
  concat(cast(k % 997 + 1 as varchar(20)), ' ', st, ' Street') as address,
  lpad(cast(k % 900 as varchar(20)), 5, '1') as postal_code
from k
union all
select 'web', concat('B', d),
  case when k % 7 = 0 then concat(fn, 'e') else upper(fn) end,
  case when k % 13 = 0 then concat(ln, '-Harrison') else ln end,
  case when k % 2 = 0 then concat(' ', upper(fn), '.', upper(ln), d, '@EXAMPLE.COM ')
       when k % 5 = 0 then '' else null end,
  case when k % 4 = 0 then concat('555', p) else null end,
  case when k % 11 = 0 then concat('PO Box ', cast(k as varchar(20)))
       else concat(cast(k % 997 + 1 as varchar(20)), ' ', st, ' St') end,
  lpad(cast(k % 900 as varchar(20)), 5, '1')
from k
"""

# The same records after every third one of `web` has been sent again with another name, no phone and
# an address that it shares with others sent again.
CORRECTED_SQL = f"""
select source, id, case when moved then 'Zed' else first_name end as first_name, last_name,
  case when moved then concat('moved', cast(k % 50 as varchar(20)), '@example.org') else email end as email,
  case when moved then null else phone end as phone, address, postal_code
from (select *, source = 'web' and k % 3 = 0 as moved
  from (select *, cast(substr(id, 2, 12) as bigint) as k from ({PERSON_SQL}) p) q) r
"""

ATTRIBUTES = [
    Attribute("id", "TEXT", required=True),
    Attribute("first_name", "NAME", "FIRST"),
    Attribute("last_name", "NAME", "LAST"),
    Attribute("email", "EMAIL", match_key=True),
    Attribute("phone", "PHONE_NUMBER", match_key=True),
    Attribute("address", "ADDRESS"),
    Attribute("postal_code", "TEXT", "POSTAL_CODE"),
]

NAME_ADDRESS = Rule("name-address", (
    Exact("postal_code"), Fuzzy("first_name", 0.8), Fuzzy("last_name", 0.8), Fuzzy("address", 0.7),
))
RULES = [Rule("email", (Exact("email"),)), Rule("phone", (Exact("phone"),)), NAME_ADDRESS]

NORMALIZERS = {
    "first_name": n.norm_name, "last_name": n.norm_name, "email": n.norm_email,
    "phone": n.norm_phone, "address": n.norm_address, "postal_code": n.norm_postal,
}


def person(spark: SparkSession, sf_dir: str, sql: str = PERSON_SQL) -> DataFrame:
    """Keys are dealt out first: a customer takes a few bytes and makes two records, of which the
    normalizers and all that follows would else run in as many tasks as the file has splits."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey").repartition("c_custkey")
    return spark.sql(sql, customer=customer)


def normalized_person(spark: SparkSession, sf_dir: str, sql: str = PERSON_SQL) -> DataFrame:
    clean = [f(F.col(c)).alias(c) for c, f in NORMALIZERS.items()]
    return person(spark, sf_dir, sql).select("source", "id", *clean)
