"""Changes of state as pure transforms: each gives the full new table. Nothing but an explicit unflag ends a suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import local_part, name_key, proximity_tier, release_company, split_at_first

DERIVED = ["suppressed", "cm-active", "cm-unsubscribed", "cm-deleted"]
CM_REASONS = {"active": "already an active CM subscriber", "unsubscribed": "opted out in CM", "deleted": "deleted / hard-bounced in CM"}
#: Which of several subscriber states of an address counts.
PRECEDENCE = {"active": 3, "unsubscribed": 2, "deleted": 1}


# ---- keyed writes: rows whose key has a null never meet another


def first_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key whose parts are all there; rows with a null in the key all stay."""
    whole = F.expr(" and ".join(f"`{k}` is not null" for k in keys))
    first = rows.filter(whole).withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")
    return first.unionByName(rows.filter(~whole))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """old and those rows of new whose key is not there yet, the first of each."""
    fresh = first_of(new, keys, order).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column], change) -> DataFrame:
    """old and new by key; change(column, old, new) gives a column of rows that are in both. `inserted` tells new rows."""
    whole = F.expr(" and ".join(f"`{k}` is not null" for k in keys))
    fresh = first_of(new, keys, order)
    names = [c for c in old.columns if c not in keys]
    a = old.filter(whole).select(*keys, F.struct(*names).alias("__o"))
    b = fresh.filter(whole).select(*keys, F.struct(*names).alias("__n"))
    both = F.col("__o").isNotNull() & F.col("__n").isNotNull()
    value = lambda c: F.when(both, change(c, F.col(f"__o.{c}"), F.col(f"__n.{c}"))).otherwise(F.when(F.col("__o").isNotNull(), F.col(f"__o.{c}")).otherwise(F.col(f"__n.{c}")))
    met = a.join(b, keys, "full").select(*keys, *[value(c).alias(c) for c in names], F.col("__o").isNull().alias("inserted"))
    return met.unionByName(old.filter(~whole).withColumn("inserted", F.lit(False))).unionByName(fresh.filter(~whole).withColumn("inserted", F.lit(True)))


def fill_null(column: str):
    return lambda c, o, n: F.coalesce(o, n) if c == column else o


def greatest_of(column: str):
    return lambda c, o, n: F.greatest(o, n) if c == column else o


def replace_if(column: str, condition):
    return lambda c, o, n: F.when(condition(o), n).otherwise(o) if c == column else o


def site_unknown(site: Column) -> Column:
    """Whether a site is none of its organisation's: missing, or a map's."""
    return site.isNull() | F.contains(site, F.lit("google.com/maps"))


def prefer_new(c: str, o: Column, n: Column) -> Column:
    return n


def update_by_id(rows: DataFrame, changes: DataFrame, column: str, key: str = "id") -> DataFrame:
    """rows with a column taken from changes (key, column) where that has the key."""
    new = changes.select(F.col(key), F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    return rows.join(new, key, "left").withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))).drop("__new", "__hit").select(*rows.columns)


# ---- business rules


def ledger_refresh(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    """Company where it is missing, then disposition: suppressed before subscriber states, and back into play only from
    a stage that this rule owns. What was sent is never opened again."""
    names = dealerships.select(F.col("id").alias("dealership_id"), F.col("name").alias("__dealer"))
    rows = contacts.join(names, "dealership_id", "left")
    release = F.when(F.col("source") == "newspress", release_company(F.col("source_detail")))
    rows = rows.withColumn("company", F.coalesce("company", "__dealer", release))
    stage = F.col("ruled_out_stage")
    owned = stage.isNull() | stage.isin(DERIVED)
    off, cm = F.col("suppressed") & owned, ~F.col("suppressed") & F.col("cm_status").isin(list(CM_REASONS)) & owned
    back = (F.col("disposition") == "ruled_out") & ~F.col("suppressed") & (F.col("cm_status").isNull() | (F.col("cm_status") == "not_found")) & F.coalesce(stage.isin(DERIVED), F.lit(False))
    cm = F.coalesce(cm, F.lit(False))
    reason = F.create_map(*[F.lit(x) for kv in CM_REASONS.items() for x in kv])
    return rows.select(
        *[c for c in contacts.columns if c not in ("disposition", "ruled_out_stage", "ruled_out_reason")],
        F.when(off | cm, "ruled_out").when(back, "in_play").otherwise(F.col("disposition")).alias("disposition"),
        F.when(off, "suppressed").when(cm, F.concat(F.lit("cm-"), "cm_status")).when(back, None).otherwise(stage).alias("ruled_out_stage"),
        F.when(off, F.coalesce("suppress_reason", F.lit("suppressed"))).when(cm, F.try_element_at(reason, F.col("cm_status"))).when(back, None).otherwise(F.col("ruled_out_reason")).alias("ruled_out_reason"),
    ).select(*contacts.columns)


def subscriber_stamp(contacts: DataFrame, states: DataFrame, skip_prefix: str = "Campaign-") -> DataFrame:
    """cm_status of every contact with an address: its strongest state on any list, else not_found."""
    rank = F.create_map(*[F.lit(x) for kv in PRECEDENCE.items() for x in kv])
    best = states.filter(~F.col("list_name").startswith(skip_prefix)).groupBy(F.lower("email").alias("__email")).agg(F.max_by("state", F.try_element_at(rank, F.col("state"))).alias("__state"))
    rows = contacts.join(best, F.lower("email") == F.col("__email"), "left")
    return rows.withColumn("cm_status", F.when(F.col("email").isNotNull(), F.coalesce("__state", F.lit("not_found"))).otherwise(F.col("cm_status"))).select(*contacts.columns)


def account_ruleout(contacts: DataFrame, accounts: DataFrame, stage: str = "wp-member") -> DataFrame:
    held = accounts.select(F.lower(F.trim("email")).alias("__email")).distinct().withColumn("__held", F.lit(True))
    rows = contacts.join(held, F.lower("email") == F.col("__email"), "left")
    hit = F.coalesce("__held", F.lit(False)) & (F.col("disposition") == "in_play")
    changed = {"disposition": F.when(hit, "ruled_out").otherwise(F.col("disposition")), "ruled_out_stage": F.when(hit, stage).otherwise(F.col("ruled_out_stage")), "ruled_out_reason": F.when(hit, "already has an account").otherwise(F.col("ruled_out_reason"))}
    return rows.withColumns(changed).select(*contacts.columns)


def suppress_domains(contacts: DataFrame, domains: list[str] = vocab.MEDIA_DOMAINS, reason: str = "media_domain") -> DataFrame:
    hit = F.coalesce(F.col("email_domain").isin(domains), F.lit(False))
    return contacts.withColumns({"suppressed": F.col("suppressed") | hit, "suppress_reason": F.when(hit, reason).otherwise(F.col("suppress_reason"))})


def suppress_undeliverable(contacts: DataFrame, statuses: tuple[str, ...] = ("dead_domain", "undeliverable", "bad_syntax")) -> DataFrame:
    hit = F.coalesce(F.col("verify_status").isin(list(statuses)), F.lit(False)) & ~F.col("suppressed")
    return contacts.withColumns({"suppressed": F.col("suppressed") | hit, "suppress_reason": F.when(hit, F.concat(F.lit("verify:"), "verify_status")).otherwise(F.col("suppress_reason"))})


def flag_stale(contacts: DataFrame, chosen: Column, undo: bool = False) -> DataFrame:
    """People who left: suppressed with that reason; undone only where that is the reason."""
    left = "left_employer"
    if undo:
        hit = F.coalesce(chosen & (F.col("suppress_reason") == left), F.lit(False))
        return contacts.withColumns({"suppressed": F.col("suppressed") & ~hit, "suppress_reason": F.when(~hit, F.col("suppress_reason"))})
    hit = F.coalesce(chosen, F.lit(False))
    return contacts.withColumns({"suppressed": F.col("suppressed") | hit, "suppress_reason": F.when(hit, left).otherwise(F.col("suppress_reason"))})


def duplicate_candidates(contacts: DataFrame) -> DataFrame:
    """Contacts whose local part is two words and no shared inbox and whose name is a person's; lp is the local part."""
    own = local_part(F.col("email"))
    rows = contacts.filter(F.col("email").isNotNull() & ~F.col("suppressed") & own.rlike("^[a-z]+[._][a-z]+$") & ~own.rlike(vocab.SHARED_WORDS) & F.coalesce("full_name", F.lit("")).rlike("^[A-Za-z]+ +[A-Za-z]"))
    return rows.withColumn("lp", F.lower(own))


def cross_domain_duplicates(contacts: DataFrame) -> DataFrame:
    """id and keep of people found under one local part in two to four domains and one name; one row of each is kept."""
    rows = duplicate_candidates(contacts).select("id", F.col("lp").alias("local"), F.lower("email_domain").alias("domain"), F.lower("full_name").alias("name"), "export_batch")
    groups = rows.groupBy("local").agg(F.countDistinct("domain").alias("domains"), F.countDistinct("name").alias("names")).filter("domains between 2 and 4 and names = 1")
    order = Window.partitionBy("local").orderBy(F.when(F.col("domain").endswith(".au"), 0).otherwise(1), F.when(F.contains("domain", F.lit("marketing")), 1).otherwise(0), F.col("export_batch").asc_nulls_last(), "id")
    return rows.join(groups, "local").select("id", "local", "domain", (F.row_number().over(order) == 1).alias("keep"))


def dedupe_domains(contacts: DataFrame) -> DataFrame:
    drop = cross_domain_duplicates(contacts).filter(~F.col("keep")).select("id", F.lit(True).alias("__drop"))
    hit = F.coalesce("__drop", F.lit(False))
    rows = contacts.join(drop, "id", "left").withColumns({"suppressed": F.col("suppressed") | hit, "suppress_reason": F.when(hit, "cross_domain_dupe").otherwise(F.col("suppress_reason"))})
    return rows.select(*contacts.columns)


def classify_proximity(contacts: DataFrame) -> DataFrame:
    return contacts.withColumn("proximity_tier", proximity_tier(F.col("source"), F.col("email_domain")))


def sweep_reconcile(contacts: DataFrame, sweep: DataFrame, as_of: Column) -> DataFrame:
    """Bounces rule out for good (unless that is known); absence notes only stamp a date where there is none."""
    found = sweep.groupBy(F.lower("email").alias("__email")).agg(F.max(F.col("kind") == "bounce").alias("__bounce"), F.max(F.col("kind") == "ooo").alias("__away"), F.min(F.when(F.col("kind") == "ooo", F.col("evdate"))).alias("__date"))
    rows = contacts.join(found, F.lower("email") == F.col("__email"), "left")
    bounce = F.coalesce("__bounce", F.lit(False)) & ~F.col("ruled_out_stage").eqNullSafe("bounce")
    away = F.coalesce("__away", F.lit(False)) & F.col("ooo_at").isNull()
    set_to = lambda c, v: F.when(bounce, v).otherwise(F.col(c))
    changed = {"suppressed": F.col("suppressed") | bounce, "suppress_reason": set_to("suppress_reason", "hard_bounce"), "disposition": set_to("disposition", "ruled_out"), "ruled_out_stage": set_to("ruled_out_stage", "bounce"), "ruled_out_reason": set_to("ruled_out_reason", "reach NDR: 550 recipient not found"), "ooo_at": F.when(away, F.coalesce("__date", as_of)).otherwise(F.col("ooo_at"))}
    return rows.withColumns(changed).select(*contacts.columns)


def cleanup_labels(contacts: DataFrame, labels: list[str] = vocab.LABELS, patterns: list[str] = vocab.DEPARTMENTS) -> DataFrame:
    """Rows without an address whose name is a label of a department or page go."""
    name = F.lower(F.trim(F.coalesce("full_name", F.lit(""))))
    return contacts.filter(~(F.col("email").isNull() & (name.isin(labels) | name.rlike("|".join(f"({p})" for p in patterns)))))


def duplicate_groups(contacts: DataFrame) -> DataFrame:
    """Local parts that one person has at two to four domains: domains, names, people, and how many are redundant."""
    rows = duplicate_candidates(contacts)
    groups = rows.groupBy("lp").agg(F.count_distinct("email_domain").alias("domains"), F.count_distinct(F.lower("full_name")).alias("names"), F.count("*").alias("people"))
    return groups.filter("domains between 2 and 4 and names = 1").withColumn("redundant", F.col("people") - 1)


def active_subscribers(states: DataFrame) -> DataFrame:
    """Active subscribers, one row for each address, as the table that is written anew holds them."""
    rows = states.filter("state = 'active'").groupBy(F.lower("email").alias("email")).agg(F.max_by(F.trim("name"), "name").alias("nm"))
    first, rest = split_at_first(F.col("nm"))
    return rows.select("email", first.alias("first_name"), rest.alias("last_name"), F.nullif(name_key(F.col("nm")), F.lit("")).alias("name_key"))


def scrape_transition(dealerships: DataFrame, having: str = "website_url") -> DataFrame:
    """dealerships after a look for their page about people: those just found have one, or none."""
    found = F.when(F.col(having).isNull(), "no_team_page").otherwise("team_found")
    return dealerships.withColumn("scrape_state", F.when(F.col("scrape_state") == "discovered", found).otherwise(F.col("scrape_state")))


def toggle_stale(contacts: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """contacts after the flag "left employer" of some ids is turned, and what became of each id: flagged, cleared or
    not_found. A cleared contact is in play again, whatever ruled it out."""
    left = "left_employer"
    asked = ids.select("id").filter("id is not null").distinct()
    rows = contacts.join(asked.withColumn("__asked", F.lit(True)), "id", "left")
    hit = F.coalesce("__asked", F.lit(False))
    clear = hit & F.col("suppress_reason").eqNullSafe(left)
    to = lambda c, on, off: F.when(clear, off).when(hit, on).otherwise(F.col(c))
    changed = {"suppressed": to("suppressed", F.lit(True), F.lit(False)), "suppress_reason": to("suppress_reason", left, F.lit(None)), "disposition": to("disposition", "ruled_out", "in_play"), "ruled_out_stage": to("ruled_out_stage", left, F.lit(None)), "ruled_out_reason": to("ruled_out_reason", "flagged in cockpit — left employer / outdated", F.lit(None))}
    known = contacts.select("id", F.when(F.col("suppress_reason").eqNullSafe(left), "cleared").otherwise("flagged").alias("outcome"))
    outcome = asked.join(known, "id", "left").select("id", F.coalesce("outcome", F.lit("not_found")).alias("outcome"))
    return rows.withColumns(changed).select(*contacts.columns), outcome


def stamp_group(contacts: DataFrame, batch: DataFrame, label: str = "NP-B01") -> DataFrame:
    """contacts with a label as the send_group of a batch's ids."""
    return update_by_id(contacts, batch.select("id").distinct().withColumn("send_group", F.lit(label)), "send_group")
