"""All tables kept up to date batch by batch, from signed changes instead of a rebuild.

A batch of bronze rows replaces the newest version of some postings. Each such posting gives two change rows: the
version that no longer holds (sign -1) and the one that does (sign +1). Changes carry everything downstream:

- counts behind the skill and certification dimensions add the signs up;
- companies and locations that occur in a change are derived anew, and upserted by buckets;
- bridges and the latest postings replace the buckets of changed ids, facts the batch days;
- lines replace the days that a posting left or came to, and the days of postings whose company or
  location row has changed; the marts, the median state and the demand index follow the lines' days.

Tables are ``Parts``: parts that no change touches are neither read for the write nor written. Every table notes the
batch it has applied, and the latest postings, which changes are computed from, are replaced last; so a batch that runs again
after a failure ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.keys import company_id, location_id
from demandlens.operators import entities
from demandlens.operators.latest import latest_by_key
from demandlens.operators.upsert import upsert_parts
from demandlens.plans import dims, facts, marts, quality
from demandlens.plans.demand_index import MONTH, demand_index, month_of
from demandlens.plans.dims import version_order
from demandlens.plans.lines import job_posting_lines, posting_lines
from demandlens.plans.refresh import FOUND, Settings, _staging
from demandlens.sources.parts import Parts, bucket, values, without
from demandlens.sources.tables import overwrite, read_table

BUCKET = "bucket"
#: Column that names the parts of each table.
TABLES = {
    "latest": BUCKET, "staging": BUCKET, "bridge_job_skills": BUCKET, "bridge_job_certifications": BUCKET,
    "bridge_job_locations": BUCKET, "companies": BUCKET, "locations": BUCKET, "skill_uses": BUCKET, "cert_uses": BUCKET,
    "skills": BUCKET, "certifications": BUCKET, "job_postings": "_batch_date", "job_postings_slim": "_batch_date",
    "job_posting_lines": "posting_date", "skill_daily": "posting_date", "cert_daily": "posting_date",
    "role_state": "posting_date", "role_daily": "business_date", "demand_index": MONTH,
}
#: What lines show of a company and of a location.
SHOWN = {"companies": ("company_id", ["name", "domain", "industry"]), "locations": ("location_id", ["country_name"])}


class Batch:
    """One batch on its way through the tables."""

    def __init__(self, spark: SparkSession, s: Settings, number: int, buckets: int):
        self.spark, self.s, self.number, self.buckets = spark, s, number, buckets
        self.tables = {name: Parts(spark, s.path(name), by) for name, by in TABLES.items()}

    def applied(self, name: str) -> bool:
        return self.tables[name].exists() and self.tables[name].batch() >= self.number

    def read(self, name: str, parts: list | None = None) -> DataFrame | None:
        table = self.tables[name]
        return table.read(parts) if table.exists() else None

    def bucketed(self, df: DataFrame, key: str | Column) -> DataFrame:
        return df.withColumn(BUCKET, bucket(key, self.buckets))

    def replace(self, name: str, make: Callable[[], tuple[DataFrame, list]]) -> None:
        """Replace the touched parts that ``make`` names, unless a run before has done it."""
        if not self.applied(name):
            df, touched = make()
            table = self.tables[name]
            table.replace(df, touched if table.exists() else None, self.number)

    def replace_rows(self, name: str, new: DataFrame, keys: DataFrame, key: str, touched: list) -> None:
        """Rows of ``keys`` go from the touched parts, rows of ``new`` come."""
        def make():
            old = self.read(name, touched)
            return (new if old is None else without(old, keys, key).unionByName(new)), touched

        self.replace(name, make)

    def add_counts(self, name: str, signed: DataFrame, keys: list[str], by: Column) -> None:
        """Sum ``sign`` up per ``keys``; counts that reach zero go."""
        def make():
            delta = self.bucketed(signed.groupBy(*keys).agg(F.sum("sign").alias("n")).where("n <> 0"), by)
            touched = values(delta, BUCKET)
            old = self.read(name, touched)
            both = delta if old is None else old.unionByName(delta)
            return both.groupBy(*keys, BUCKET).agg(F.sum("n").alias("n")).where("n > 0"), touched

        self.replace(name, make)


def found_entities(spark: SparkSession, rows: DataFrame, s: Settings) -> DataFrame:
    """The rows with their entities."""
    if s.extractor is None:
        return rows.withColumn(FOUND, entities.dictionary_entities("description", s.terms))
    named = F.struct(F.col("cert_name").alias("name"), F.col("cert_provider").alias("provider"))
    staged = _staging(spark, rows, s).groupBy("job_id").agg(F.collect_list(named).alias(FOUND))
    return rows.join(staged, "job_id", "left").withColumn(FOUND, F.coalesce(FOUND, F.array().cast(entities.ENTITIES)))


def changes(b: Batch, bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed change rows, and the next state of the buckets of ``latest`` that the batch touches; both stored."""
    work = b.s.path(f"_changes/batch={b.number}")
    incoming = b.bucketed(facts.latest_postings(bronze), "job_id")
    touched = values(incoming, BUCKET)
    old = b.read("latest", touched)
    given = found_entities(b.spark, incoming, b.s).withColumn("_given", F.lit(True))
    if old is None:
        overwrite(given.drop("_given"), f"{work}/latest")
        stored = read_table(b.spark, f"{work}/latest")
        overwrite(stored.withColumn("sign", F.lit(1)), f"{work}/rows")
    else:
        both = given.unionByName(old.withColumn("_given", F.lit(False)))
        # Of equal versions the stored one stays, so a row that is sent again changes nothing.
        overwrite(latest_by_key(both, ["job_id"], [*version_order(), F.col("_given")]), f"{work}/latest")
        stored = read_table(b.spark, f"{work}/latest")
        after = stored.where("_given").drop("_given")
        before = old.join(after.select("job_id"), "job_id", "left_semi")
        overwrite(after.withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1))), f"{work}/rows")
        stored = stored.drop("_given")
    return read_table(b.spark, f"{work}/rows"), stored


def apply_batch(spark: SparkSession, bronze: DataFrame, s: Settings, number: int, buckets: int = 64) -> dict[str, DataFrame]:
    """Bring all tables under ``s.base`` from the batches before to this one too; ``number`` grows from batch to batch.

    The result is that of a rebuild from all bronze rows so far, but for run dates: rows that no change touches keep theirs.
    A batch with a number that has been applied does nothing. Raises before lines are written if a posting would have two.
    """
    b = Batch(spark, s, number, buckets)
    if not b.applied("latest"):
        signed, next_latest = changes(b, bronze)
        touched = values(next_latest, BUCKET)
        rest = b.read("latest", sorted(set(b.tables["latest"].parts()) - set(map(str, touched))))
        every = next_latest if rest is None else rest.unionByName(next_latest)
        _star(b, signed, every)
        _lines_and_marts(b, signed, every)
        b.replace("latest", lambda: (next_latest, touched))
    return {name: table.read() for name, table in b.tables.items()} | {"roles": read_table(spark, s.path("roles"))}


def _star(b: Batch, signed: DataFrame, every: DataFrame) -> None:
    """Dimensions, bridges and facts."""
    s, after = b.s, signed.where("sign > 0").drop("sign")
    ids, touched = signed.select("job_id"), values(signed, BUCKET)
    overwrite(dims.roles(b.spark, s.taxonomy, s.at), s.path("roles"))

    b.add_counts("skill_uses", dims.skill_uses(signed), ["slug", "category"], F.col("slug"))
    named = signed.select("sign", F.inline(FOUND).alias("cert_name", "cert_provider")).where(F.col("cert_name").isNotNull())
    b.add_counts("cert_uses", named, ["cert_name", "cert_provider"], F.lower("cert_name"))
    for name, made, key, shown in (
        ("skills", lambda: dims.skills_of_uses(b.read("skill_uses"), s.at), "name", ["name", "category"]),
        ("certifications", lambda: dims.certifications_of_uses(b.read("cert_uses"), s.at), "cert_id", ["name", "provider"]),
    ):
        if not b.applied(name):
            # The old dimension says which names the marts have to show anew.
            overwrite(_differing(b.read(name), made(), key, shown), s.path(f"_changes/batch={b.number}/{name}"))
            b.replace(name, lambda made=made: (b.bucketed(made(), "name"), list(range(b.buckets))))
    for name, key, derive, own in (
        ("companies", _company(), dims.companies, "company_id"),
        ("locations", _location(), lambda rows: dims.locations(rows, dict(s.continent_codes)), "location_id"),
    ):
        if not b.applied(name):
            _dimension(b, name, signed, every, key, derive, own)

    bridges = {
        "staging": entities.inline_entities(after, "job_id", FOUND),
        "bridge_job_skills": facts.bridge_job_skills(after, s.at),
        "bridge_job_locations": facts.bridge_job_locations(after, s.at),
    }
    bridges["bridge_job_certifications"] = facts.bridge_job_certifications(bridges["staging"], s.at)
    for name, rows in bridges.items():
        b.replace_rows(name, b.bucketed(rows, "job_id"), ids, "job_id", touched)
    for name, make, day in (
        ("job_postings", lambda rows: facts.fact_postings(rows, s.taxonomy, s.at), "discovered_at"),
        ("job_postings_slim", lambda rows: facts.fact_postings_slim(rows, s.taxonomy), "_bronze_processed_at"),
    ):
        b.replace_rows(name, make(after), ids, "job_id", values(signed.select(F.to_date(day).alias("day")), "day"))


def _differing(old: DataFrame | None, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Old and new ``name`` of the keys of both whose columns differ."""
    if old is None:
        return new.select("name").limit(0)  # first load: nothing stored shows a name
    before, after = (df.groupBy(key).agg(F.max(F.struct(*columns)).alias(side)) for df, side in ((old, "before"), (new, "after")))
    both = before.join(after, key).where("before <> after or isnull(before) <> isnull(after)")
    return both.select(F.explode(F.array("before.name", "after.name")).alias("name")).distinct()


def _company() -> Column:
    """The key of a posting's company, NULL if it names none; as lines look it up."""
    return F.when(F.coalesce("co_id", "co_name", "company").isNotNull(), company_id())


def _location() -> Column:
    return F.when(F.col("loc_id").isNotNull() | F.col("location").isNotNull(), location_id())


def _dimension(b: Batch, name: str, signed: DataFrame, every: DataFrame, key: Column, derive, own: str) -> None:
    """Rows of the keys in the changes, derived from all latest postings that have them; keys whose shown columns change are noted."""
    touched_keys = signed.select(key.alias("_key")).distinct()
    rows = every.withColumn("_key", key).join(touched_keys, "_key", "left_semi").drop("_key")
    work = b.s.path(f"_changes/batch={b.number}")
    overwrite(derive(rows), f"{work}/new_{name}")
    new, table = read_table(b.spark, f"{work}/new_{name}"), b.tables[name]
    buckets = values(touched_keys.select(bucket("_key", b.buckets).alias(BUCKET)), BUCKET)
    old = b.read(name, buckets)
    gone = touched_keys.withColumnRenamed("_key", own)
    shown = [own, *SHOWN[name][1]]
    if old is None:
        moved = new.select(own).limit(0)
    else:
        kept = old.join(gone, own, "left_semi").select(*shown)
        moved = new.select(*shown).exceptAll(kept).select(own)
        if name == "locations":  # goes with the last posting that names it; one that has only its id may be left
            moved = moved.union(without(kept, new, own).select(own))
    overwrite(moved, f"{work}/moved_{name}")
    if name == "companies":
        upsert_parts(table, new, own, dims.COMPANY_ATTRIBUTES, b.buckets, b.s.at, b.number)
    else:
        b.replace_rows(name, b.bucketed(new, own), gone, own, buckets)


def _lines_and_marts(b: Batch, signed: DataFrame, every: DataFrame) -> None:
    s, work = b.s, b.s.path(f"_changes/batch={b.number}")
    day = F.to_date("date_posted").alias("posting_date")
    touched = signed.select("job_id", day)
    for name, key in (("companies", _company()), ("locations", _location())):
        moved = read_table(b.spark, f"{work}/moved_{name}")
        if moved.limit(1).count():
            own = SHOWN[name][0]
            at = every.select("job_id", day, key.alias(own)).join(moved.distinct(), own, "left_semi")
            touched = touched.union(at.select("job_id", "posting_date"))
    overwrite(touched.distinct(), f"{work}/touched_lines")
    touched = read_table(b.spark, f"{work}/touched_lines")
    ids, days = touched.select("job_id").distinct(), values(touched, "posting_date")
    if not b.applied("job_posting_lines"):
        rows = every.join(ids, "job_id", "left_semi")
        made = job_posting_lines(posting_lines(rows, b.read("companies"), b.read("locations"), s.taxonomy, F.col(FOUND)), s.as_of)
        overwrite(made, f"{work}/new_lines")
        new = read_table(b.spark, f"{work}/new_lines", made.schema)
        repeated = quality.repeated_keys(new, "job_id").limit(5).collect()
        if repeated:
            raise ValueError(f"job_posting_lines would have repeated ids, such as {[r['job_id'] for r in repeated]}")
        b.replace_rows("job_posting_lines", new, ids, "job_id", days)
    for name, dim, column, mart in (
        ("skill_daily", "skills", "skill_name", marts.skill_daily), ("cert_daily", "certifications", "cert_name", marts.cert_daily),
    ):
        def make(name=name, dim=dim, column=column, mart=mart):
            names, affected = read_table(b.spark, f"{work}/{dim}"), set(days)
            if names.limit(1).count():
                tags = b.read("job_posting_lines").select("posting_date", F.explode(f"{column}s").alias("name"))
                affected |= set(values(tags.join(names, "name", "left_semi"), "posting_date"))
            chosen = sorted(d for d in affected if d is not None)
            return mart(b.read("job_posting_lines", chosen), b.read(dim), s.as_of), chosen

        b.replace(name, make)
    def indexed():
        months = values(touched.where("posting_date is not null").select(month_of("posting_date").alias(MONTH)), MONTH)
        fresh = demand_index(b.read("job_posting_lines", [d for d in days if d is not None]))
        old = b.read("demand_index", months)  # counts of the other days of a touched month stay
        return fresh if old is None else without(old, touched, "posting_date").unionByName(fresh), months

    b.replace("demand_index", indexed)
    b.replace("role_state", lambda: (marts.role_state(b.read("job_posting_lines", days)), days))
    b.replace("role_daily", lambda: (marts.role_daily(b.read("job_posting_lines"), s.as_of, b.read("role_state")), [s.as_of]))


def follow(stream: DataFrame, s: Settings, checkpoint: str, buckets: int = 64):
    """Apply every micro-batch of a stream of bronze rows, then stop; returns the finished query.

    The checkpoint numbers the batches, and a batch that was cut off comes again with its number.
    """
    def one(rows: DataFrame, number: int) -> None:
        apply_batch(rows.sparkSession, rows, s, number, buckets)

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
