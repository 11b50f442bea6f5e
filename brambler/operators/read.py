"""Read models: counts, pages, pools, send monitor. Each takes tables and gives a DataFrame."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import is_role_inbox, local_day, name_key
from .preflight import contained, earlier_mail

HEALTH_EXCLUDED = ["dead_domain", "undeliverable", "bad_syntax"]
#: Shares of sent mail from which the monitor warns or stops.
COMPLAINT_STOP, BOUNCE_STOP, BOUNCE_WARN = 0.0005, 0.03, 0.02


def summary_totals(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    c = contacts.agg(F.count("*").alias("contacts"), F.count("email").alias("with_email"), F.count("export_batch").alias("exported"), F.count_if("suppressed").alias("suppressed"))
    return c.crossJoin(dealerships.agg(F.count("*").alias("dealerships")))  # one row each


def counts_by(contacts: DataFrame, column: str, missing: str = "unchecked") -> DataFrame:
    return contacts.groupBy(F.coalesce(F.col(column), F.lit(missing)).alias("label")).agg(F.count("*").alias("n"))


def send_group_counts(contacts: DataFrame) -> DataFrame:
    return contacts.filter("send_group is not null").groupBy("send_group").agg(F.count("*").alias("n"), F.min("export_batch").alias("first_batch"))


def brand_coverage(dealerships: DataFrame, contacts: DataFrame) -> DataFrame:
    d, c = dealerships.select("id", "brand_slug"), contacts.select("dealership_id", F.col("id").alias("contact_id"), "email")
    joined = d.join(c, d.id == c.dealership_id, "left")
    return joined.groupBy("brand_slug").agg(F.countDistinct("id").alias("dealers"), F.count("contact_id").alias("contacts"), F.count("email").alias("emails"))


def with_dealership(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    d = dealerships.select(F.col("id").alias("dealership_id"), F.col("brand_slug"), F.col("name").alias("dealership"), "state", "suburb")
    return contacts.join(d, "dealership_id", "left")


def page_order(by: str) -> list[Column]:
    """Total orders of a page of contacts; nulls are placed on purpose."""
    return {
        "newest": [F.col("source_date").desc_nulls_last(), F.col("id").desc()],
        "email": [F.col("email").asc_nulls_last(), F.col("id").asc()],
        "batch": [F.col("export_batch").asc_nulls_last(), F.col("id").asc()],
        "name": [F.col("full_name").asc_nulls_last(), F.col("id").asc()],
    }[by]


def contacts_page(rows: DataFrame, by: str = "newest", limit: int = 100, offset: int = 0) -> DataFrame:
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("a page has 1 to 1000 rows and starts at 0 or later")
    return rows.orderBy(*page_order(by)).offset(offset).limit(limit)


def contacts_filtered(rows: DataFrame, search: str | None = None, emailable: bool | None = None, **equal: str | None) -> DataFrame:
    """Conjunction of what is given; '', 'unchecked' and 'null' ask for nulls. The needle's % and _ stay wild."""
    found = [F.col(k).isNull() if v in ("", "unchecked", "null") else F.col(k) == v for k, v in equal.items() if v is not None]
    if emailable is not None:
        found.append(F.col("email").isNotNull() if emailable else F.col("email").isNull())
    if search:
        found.append(functools.reduce(operator.or_, [F.coalesce(F.col(c).ilike(f"%{search}%"), F.lit(False)) for c in ("full_name", "email", "company", "dealership") if c in rows.columns]))
    return rows.filter(functools.reduce(operator.and_, found, F.lit(True)))


def free_to_mail() -> Column:
    return F.col("email").isNotNull() & ~F.col("suppressed") & (F.col("cm_status").isNull() | (F.col("cm_status") == "not_found"))


def sendable_pool(contacts: DataFrame, include_inferred: bool = False) -> DataFrame:
    pool = contacts.filter((F.col("disposition") == "in_play") & F.col("sent_at").isNull() & free_to_mail())
    return pool if include_inferred else pool.filter(F.col("confidence") == "direct")


def exportable_pool(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    rows = with_dealership(contacts.filter(free_to_mail()), dealerships)
    return rows.withColumn("brand_slug", F.coalesce("brand_slug", F.lit(""))).withColumn("dealership", F.coalesce("dealership", "company", F.lit("")))


def daily_selection(contacts: DataFrame, quota: int = 25, per_domain: int | None = None) -> DataFrame:
    """The day's addresses by batch and id; with per_domain, only that many of each domain come into question."""
    own = (F.col("confidence") == "direct") | (F.col("source") == "goauto")
    rows = contacts.filter(own & (F.col("disposition") == "in_play") & (F.col("cm_status") == "not_found") & F.col("sent_at").isNull() & F.col("email").isNotNull() & ~F.col("suppressed"))
    if per_domain:
        rank = F.row_number().over(Window.partitionBy("email_domain").orderBy(F.col("export_batch").asc_nulls_last(), "id"))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= per_domain).drop("rank")
    return rows.orderBy(F.col("export_batch").asc_nulls_last(), "id").limit(quota)


def followup_cohort(contacts: DataFrame) -> DataFrame:
    return contacts.filter(F.col("ooo_at").isNotNull() & (F.col("cm_status") == "not_found"))


EVENTS = ["sent", "delivered", "bounced", "opened", "unsubscribed", "complained"]


def sends_by_day(events: DataFrame) -> DataFrame:
    rows = events.withColumn("day", local_day(F.col("occurred_at")))
    return rows.groupBy("day").agg(*[F.count_if(F.col("event") == e).alias(e) for e in EVENTS])


def sends_status(events: DataFrame) -> DataFrame:
    """Totals, rates (null without sent mail) and what they mean."""
    t = events.agg(*[F.count_if(F.col("event") == e).alias(e) for e in ("sent", "bounced", "complained")])
    t = t.withColumn("bounce_rate", F.try_divide("bounced", "sent")).withColumn("complaint_rate", F.try_divide("complained", "sent"))
    status = F.when(F.col("sent") == 0, "no-sends").when((F.col("complaint_rate") >= COMPLAINT_STOP) | (F.col("bounce_rate") >= BOUNCE_STOP), "stop").when(F.col("bounce_rate") >= BOUNCE_WARN, "warn").otherwise("ok")
    return t.withColumn("status", status)


def sends_health(events: DataFrame) -> DataFrame:
    """sends_status() as it is shown: rates to five places (half up), what they mean judged on whole ones."""
    return sends_status(events).withColumns({c: F.round(c, 5) for c in ("bounce_rate", "complaint_rate")})


def recent_batch(contacts: DataFrame, active_names: DataFrame, as_of: Column, months: int = 12, dated_only: bool = True) -> DataFrame:
    """Recent, healthy people of releases whose name no active subscriber has; names without a key always stay."""
    recent = F.col("source_date") >= F.add_months(as_of, -months)
    rows = contacts.filter((F.col("source") == "newspress") & ~F.col("suppressed") & (F.col("disposition") == "in_play") & (F.col("cm_status") == "not_found"))
    rows = rows.filter(F.coalesce(~F.col("verify_status").isin(HEALTH_EXCLUDED), F.lit(True))).filter(recent if dated_only else recent | F.col("source_date").isNull())
    own = F.coalesce(F.nullif(name_key(F.col("first_name"), F.col("last_name")), F.lit("")), name_key(F.col("full_name")))
    keys = active_names.select("name_key").filter("name_key <> ''").distinct()
    return rows.withColumn("name_key", own).join(keys, "name_key", "left_anti")


def preflight_matches(candidates: DataFrame, archive: DataFrame, marker: str, accounts: DataFrame | None = None) -> DataFrame:
    """Candidates whose address is part of a recipient header of an earlier mail with the marker, and that mail.

    The test is any substring. With accounts (email), only mail that these sent counts (account_email of the archive).
    """
    mail = earlier_mail(archive, marker, accounts).select("mail_id", "sent_on", F.lower("to_header").alias("to_lower"))
    found = contained(candidates, mail, "mail_id", "to_lower")
    return found.join(mail.select("mail_id", "sent_on"), "mail_id").select("id", "email", "mail_id", "sent_on")


def batch_composition(contacts: DataFrame) -> DataFrame:
    per = Window.partitionBy("export_batch", "email_domain")
    rows = contacts.filter("export_batch is not null").withColumn("same", F.count("*").over(per)).withColumn("role", is_role_inbox(F.col("email")))
    counts = [F.count_if(F.col("proximity_tier") == t).alias(f"n_{t.lower()}") for t in ("dealer", "T1", "T2", "T3")]
    return rows.groupBy("export_batch").agg(F.count("*").alias("n"), *counts, F.count_if("role").alias("n_role"), F.countDistinct("email_domain").alias("domains"), F.max("same").alias("most_of_a_domain"))


def members_by_source(contacts: DataFrame) -> DataFrame:
    return contacts.filter("ruled_out_stage = 'wp-member'").groupBy("source").agg(F.count("*").alias("n"))


def suppressed_by_status(contacts: DataFrame) -> DataFrame:
    """Suppressed contacts by verification status, each beside the total of all."""
    n = contacts.filter("suppressed").groupBy(F.coalesce("verify_status", F.lit("none")).alias("status")).agg(F.count("*").alias("n"))
    return n.crossJoin(contacts.filter("suppressed").agg(F.count("*").alias("total"))).select("status", "n", "total")  # one row


def tier_emailable(contacts: DataFrame) -> DataFrame:
    """Contacts in play by tier, and those with an address."""
    rows = contacts.filter("disposition = 'in_play'")
    return rows.groupBy(F.coalesce("proximity_tier", F.lit("none")).alias("tier")).agg(F.count("*").alias("n"), F.count("email").alias("emailable"))


def disposition_companies(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("disposition").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("company") != "", F.lit(False))).alias("with_company"))


def stage_selection(dealerships: DataFrame, stage: str, brand: str | None = None, limit: int | None = None, having: str = "website_url") -> DataFrame:
    """Organisations in a stage of the scrape that have what its next step needs, in order of their ids."""
    rows = dealerships.filter((F.col("scrape_state") == stage) & F.col(having).isNotNull())
    rows = (rows if brand is None else rows.filter(F.col("brand_slug") == brand)).select("id", "name", having).orderBy("id")
    return rows.limit(limit) if limit else rows


def export_order() -> list[Column]:
    """By brand and organisation, both as exported (empty if there is none), and name."""
    return [F.coalesce("brand_slug", F.lit("")), F.coalesce("dealership", F.lit("")), F.col("full_name").asc_nulls_last(), F.col("id")]


def recent_order() -> list[Column]:
    return [F.col("source_date").desc_nulls_last(), F.col("email").asc_nulls_last(), F.col("id")]


def sample(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def ranked(page: DataFrame, name: str, *order: Column) -> DataFrame:
    """A page (a bounded number of rows) with each row's place in an order."""
    return page.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def page_with_total(contacts: DataFrame, by: str, limit: int, offset: int) -> DataFrame:
    """total, the number of all, beside the id of each row of a page; limits from 1 to 1000, offsets from 0."""
    page = contacts.orderBy(*page_order(by)).offset(max(0, offset)).limit(min(1000, max(1, limit))).select("id")
    return page.crossJoin(contacts.agg(F.count("*").alias("total")))  # one row
