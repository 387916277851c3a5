"""Identities over several keys, near-equal strings and near-equal records."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldenrec.operators import linkage
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import register, with_ctes
from goldenrec.session import materialize, shared_dir


def keys():
    return {"email": F.lower(F.col("email")), "phone": F.col("phone")}


# The person feed and a second system in which three neighbouring customers
# share a phone: chains email - phone - email over both.
CTE_CONTACTS = """contacts as (
  select person_id as record_id, lower(trim(email)) as email, trim(phone) as phone from persons
  union all
  select 1000000000000 + c_custkey, lower(replace(c_name, '#', '.')) || '@example.com',
         '+1-555-' || lpad((c_custkey - c_custkey % 3)::varchar, 4, '0')
  from customer)"""


def contacts(spark, sf_dir):
    feed = persons(spark, sf_dir).select(F.col("person_id").alias("record_id"), "email", "phone")
    c = table(spark, sf_dir, "customer")
    crm = c.select((F.lit(1000000000000) + F.col("c_custkey")).alias("record_id"),
                   F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
                   F.concat(F.lit("+1-555-"), F.lpad((F.col("c_custkey") - F.col("c_custkey") % 3).cast("string"), 4, "0")).alias("phone"))
    return feed.unionByName(crm)


def _linked_sql(body: str) -> str:
    from goldenrec.plans.catalog import CTE_PERSONS

    return with_ctes(
        CTE_PERSONS, CTE_CONTACTS,
        "pairs as (select distinct email, phone from contacts where email is not null and phone is not null)",
        "e as (select 'e' || email as a, 'p' || phone as b from pairs union select 'p' || phone, 'e' || email from pairs)",
        "nodes as (select 'e' || email as n from contacts where email is not null union select 'p' || phone from contacts where phone is not null)",
        "reach(n, other) as (select n, n from nodes union select e.b, reach.other from reach join e on e.a = reach.n)",
        "roots as (select n, min(other) as root from reach group by n)",
        "tied as (select c.record_id, coalesce(r.root, 'r' || c.record_id) as root from contacts c left join roots r"
        " on r.n = coalesce('e' || c.email, 'p' || c.phone))",
        body=body).replace("with ", "with recursive ", 1)


LINKED_SQL = _linked_sql("select record_id as id, min(record_id) over (partition by root) as identity from tied")


@register("linked_identities", LINKED_SQL)
def q_linked_identities(spark, sf_dir):
    """K1/K4: records linked by the same email or the same phone, over chains."""
    return linkage.link_records(contacts(spark, sf_dir), "record_id", keys())


@register("linked_identities_by_runs", LINKED_SQL)
def q_linked_identities_by_runs(spark, sf_dir):
    """The same identities kept over three runs that each see a third."""
    records = materialize(contacts(spark, sf_dir), "linkage")
    store = linkage.LinkStore(shared_dir(spark, "linkage"), "record_id", keys())
    for run in range(3):
        store.add(records.filter(F.pmod(F.col("record_id"), F.lit(3)) == run), run)
    return store.link(records, run)


@register("linked_identity_sizes", _linked_sql(
    "select records, count(*)::bigint as identities from (select count(*)::bigint as records from tied group by root) group by records"))
def q_linked_identity_sizes(spark, sf_dir):
    """Identities by the number of their records."""
    linked = linkage.link_records(contacts(spark, sf_dir), "record_id", keys())
    sizes = linked.groupBy("identity").agg(F.count(F.lit(1)).alias("records"))
    return sizes.groupBy("records").agg(F.count(F.lit(1)).alias("identities"))


@register("crowded_keys", _linked_sql("""
select value, count(*)::bigint as records from (
  select 'email:' || email as value from contacts where email is not null
  union all select 'phone:' || phone from contacts where phone is not null)
group by value having count(*) > 12"""))
def q_crowded_keys(spark, sf_dir):
    """Key values that more than 12 records share, for a look by hand."""
    return linkage.crowded_keys(linkage.key_values(contacts(spark, sf_dir), "record_id", keys()), most=12)


# Account references of customers in four systems: as they are, with a sign
# lost, with a sign lost and one misread, and with three misread.
CTE_REFERENCES = """refs as (select c_custkey as k, substr(md5('account' || c_custkey::varchar), 1, 12) as r from customer),
typed as (
  select r as value from refs
  union all select substr(r, 1, k % 12) || substr(r, k % 12 + 2) from refs where k % 2 = 0
  union all select substr(r, 1, k % 12) || substr(r, k % 12 + 2, 4) || 'x' || substr(r, k % 12 + 7) from refs where k % 3 = 0
  union all select 'z' || substr(r, 2, 4) || 'z' || substr(r, 7, 5) || 'z' from refs where k % 5 = 0),
n as (select value, count(*)::bigint as records from typed group by value)"""


def references(spark, sf_dir):
    k, r = F.col("k"), F.col("r")
    refs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.left(F.md5(F.concat(F.lit("account"), F.col("c_custkey").cast("string"))), F.lit(12)).alias("r"))
    at = (k % 12).cast("int")
    first = F.substring(r, F.lit(1), at)
    lost = F.concat(first, F.substr(r, at + 2))
    misread = F.concat(first, F.substring(r, at + 2, F.lit(4)), F.lit("x"), F.substr(r, at + 7))
    three = F.concat(F.lit("z"), F.substring(r, F.lit(2), F.lit(4)), F.lit("z"), F.substring(r, F.lit(7), F.lit(5)), F.lit("z"))
    versions = [(F.lit(True), r), (k % 2 == 0, lost), (k % 3 == 0, misread), (k % 5 == 0, three)]
    return refs.select(F.explode(F.filter(F.array(*(F.when(c, v) for c, v in versions)), lambda x: x.isNotNull())).alias("value"))


def _within_sql(k: int) -> str:
    return with_ctes(
        CTE_REFERENCES,
        f"e as (select a.value as a, b.value as b from n a join n b on abs(length(a.value) - length(b.value)) <= {k} and a.value <> b.value"
        f" and levenshtein(a.value, b.value) <= {k})",
        "reach(value, other) as (select value, value from n union select e.a, reach.other from reach join e on e.b = reach.value)",
        "c as (select value, min(other) as cluster from reach group by value)",
        body="select n.value, n.records, (select count(*) from e where e.a = n.value)::bigint as n_links, c.cluster from n join c using (value)",
    ).replace("with ", "with recursive ", 1)


@register("near_duplicate_references_k2", _within_sql(2))
def q_near_duplicate_references_k2(spark, sf_dir):
    """Account references within two edits, clustered by single linkage."""
    from goldenrec.operators.editjoin import clusters_within

    return clusters_within(references(spark, sf_dir), "value", 2)


@register("near_duplicate_references_k3", _within_sql(3))
def q_near_duplicate_references_k3(spark, sf_dir):
    """G9 with three edits."""
    from goldenrec.operators.editjoin import clusters_within

    return clusters_within(references(spark, sf_dir), "value", 3)


def _gram_sql(number: int, column: str) -> str:
    text = f"lower(trim({column}))"
    return (f"case when length({text}) > 0 then list_transform(range(1, greatest(length({text}) - 2, 1) + 1),"
            f" lambda p: '{number}:' || substr({text}, p, 3)) else [] end")


PART_ATTRIBUTES = ("p_name", "p_brand", "p_type")


@register("near_equal_parts", with_ctes(
    "g as (select p_partkey as id, list_sort(list_distinct(flatten([" + ", ".join(_gram_sql(k, c) for k, c in enumerate(PART_ATTRIBUTES)) + "]))) as grams from part)",
    "s as (select grams, min(id) as rep, count(*)::bigint as copies from g group by grams)",
    "e as (select a.rep as a, b.rep as b, b.copies from s a join s b on a.rep <> b.rep and len(a.grams) >= 0.8 * len(b.grams) - 1e-9"
    " and len(b.grams) >= 0.8 * len(a.grams) - 1e-9 where len(list_intersect(a.grams, b.grams))::double"
    " / (len(a.grams) + len(b.grams) - len(list_intersect(a.grams, b.grams))) >= 0.8)",
    "reach(rep, other) as (select rep, rep from s union select e.a, reach.other from reach join e on e.b = reach.rep)",
    "c as (select rep, min(other) as cluster from reach group by rep)",
    "l as (select a as rep, sum(copies)::bigint as others from e group by a)",
    body="""select g.id, s.copies, (s.copies - 1 + coalesce(l.others, 0))::bigint as n_links, c.cluster
from g join s on g.grams = s.grams join c using (rep) left join l using (rep)""").replace("with ", "with recursive ", 1))
def q_near_equal_parts(spark, sf_dir):
    """Parts whose name, brand and type are near-equal together (Jaccard 0.8
    over 3-grams, prefix filter, exact)."""
    from goldenrec.operators.setjoin import similar_records

    return similar_records(table(spark, sf_dir, "part"), "p_partkey", PART_ATTRIBUTES)


@register("golden_near_references", with_ctes(
    CTE_REFERENCES,
    "e as (select a.value as a, b.value as b from n a join n b on abs(length(a.value) - length(b.value)) <= 2 and levenshtein(a.value, b.value) <= 2)",
    "reach(value, other) as (select value, value from n union select e.a, reach.other from reach join e on e.b = reach.value)",
    "c as (select value, min(other) as cluster from reach group by value)",
    body="""select cluster as unique_identifier, sum(records)::bigint as repetition,
       first(value order by records desc, value) as value from n join c using (value) group by cluster""").replace("with ", "with recursive ", 1))
def q_golden_near_references(spark, sf_dir):
    """G4 over near-equal values: one golden reference for each cluster, the one
    most records hold."""
    from goldenrec.operators.editjoin import clusters_within

    found = clusters_within(references(spark, sf_dir), "value", 2)
    return found.groupBy(F.col("cluster").alias("unique_identifier")).agg(
        F.sum("records").alias("repetition"), F.min_by("value", F.struct(-F.col("records"), "value")).alias("value"))
