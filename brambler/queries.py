"""Every operator as a query over the driver's tables, with SQL for DuckDB where SQL can tell the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bindings import AS_OF, domain, oracle
from .functions import scalars as S
from .functions import vocab
from .operators import html, mail, people, read, release, state
from .plans import batches
from .sources import locators

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

ROLE_INBOX = vocab.ROLE_INBOX


def query(sql: str | None = None):
    """Registers a function of tables: its parameters name them (as_is: spark and folder)."""

    def add(f):
        names = f.__code__.co_varnames[: f.__code__.co_argcount]
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[domain(spark, sf_dir, n) for n in names])
        if sql:
            ORACLES[f.__name__] = oracle(sql)
        return f

    return add


def case_of(column: str, table: dict[str, str], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{k}') THEN '{v}'" for k, v in table.items()) + f" ELSE {otherwise} END"


def among(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


FREE = "email IS NOT NULL AND NOT suppressed AND (cm_status IS NULL OR cm_status = 'not_found')"
WITH_DEALER = "contacts AS c LEFT JOIN (SELECT id AS d_id, brand_slug, name AS dealership, state, suburb FROM dealerships) AS d ON c.dealership_id = d.d_id"

# ---- read models


@query("SELECT brand_slug, count(DISTINCT d.id) AS dealers, count(c.id) AS contacts, count(c.email) AS emails FROM dealerships AS d LEFT JOIN contacts AS c ON c.dealership_id = d.id GROUP BY brand_slug")
def brand_coverage(dealerships: DataFrame, contacts: DataFrame) -> DataFrame:
    return read.brand_coverage(dealerships, contacts)


@query("SELECT * FROM (SELECT count(*) AS contacts, count(email) AS with_email, count(export_batch) AS exported, count(*) FILTER (suppressed) AS suppressed FROM contacts) AS c, (SELECT count(*) AS dealerships FROM dealerships) AS d")
def summary_totals(contacts, dealerships):
    return read.summary_totals(contacts, dealerships)


def _counts(name: str, column: str) -> None:
    def run(contacts):
        return read.counts_by(contacts, column)

    run.__name__ = name
    query(f"SELECT coalesce({column}, 'unchecked') AS label, count(*) AS n FROM contacts GROUP BY 1")(run)


for _n, _c in (("by_confidence", "confidence"), ("by_source", "source"), ("by_subscriber_state", "cm_status"), ("tier_counts", "proximity_tier"), ("verify_summary", "verify_status"), ("disposition_counts", "disposition")):
    _counts(_n, _c)


@query("SELECT send_group, count(*) AS n, min(export_batch) AS first_batch FROM contacts WHERE send_group IS NOT NULL GROUP BY send_group")
def by_send_group(contacts):
    return read.send_group_counts(contacts)


@query("SELECT brand_slug, state, count(*) AS n FROM dealerships GROUP BY brand_slug, state")
def brand_state_counts(dealerships):
    return dealerships.groupBy("brand_slug", "state").agg(F.count("*").alias("n"))


PAGE = "id, full_name, email, source, brand_slug, dealership"


def _page(by: str, order: str) -> None:
    def run(contacts, dealerships):
        return read.contacts_page(read.with_dealership(contacts, dealerships), by, 100, 50).select(*PAGE.split(", "))

    run.__name__ = f"contacts_page_{by}"
    query(f"SELECT {PAGE} FROM (SELECT c.*, brand_slug, dealership FROM {WITH_DEALER}) AS r ORDER BY {order} LIMIT 100 OFFSET 50")(run)


for _b, _o in (("newest", "source_date DESC NULLS LAST, id DESC"), ("email", "email ASC NULLS LAST, id"), ("batch", "export_batch ASC NULLS LAST, id"), ("name", "full_name ASC NULLS LAST, id")):
    _page(_b, _o)


@query(f"SELECT id, email FROM (SELECT c.*, dealership FROM {WITH_DEALER}) AS r WHERE coalesce(full_name ILIKE '%a_e%', false) OR coalesce(email ILIKE '%a_e%', false) OR coalesce(company ILIKE '%a_e%', false) OR coalesce(dealership ILIKE '%a_e%', false)")
def contacts_search(contacts, dealerships):
    return read.contacts_filtered(read.with_dealership(contacts, dealerships), "a_e").select("id", "email")


@query(f"SELECT id, brand_slug FROM (SELECT c.*, brand_slug FROM {WITH_DEALER}) AS r WHERE confidence = 'direct' AND cm_status IS NULL AND email IS NOT NULL AND source = 'manual'")
def contacts_filtered(contacts, dealerships):
    rows = read.with_dealership(contacts, dealerships)
    return read.contacts_filtered(rows, emailable=True, confidence="direct", cm_status="unchecked", source="manual").select("id", "brand_slug")


@query(f"SELECT id, email FROM contacts WHERE disposition = 'in_play' AND sent_at IS NULL AND confidence = 'direct' AND {FREE}")
def sendable_pool(contacts):
    return read.sendable_pool(contacts).select("id", "email")


@query(f"SELECT id, email, coalesce(brand_slug, '') AS brand_slug, coalesce(dealership, company, '') AS dealership FROM (SELECT c.*, brand_slug, dealership FROM {WITH_DEALER}) AS r WHERE {FREE}")
def exportable_pool(contacts, dealerships):
    return read.exportable_pool(contacts, dealerships).select("id", "email", "brand_slug", "dealership")


DAILY = "(confidence = 'direct' OR source = 'goauto') AND disposition = 'in_play' AND cm_status = 'not_found' AND sent_at IS NULL AND email IS NOT NULL AND NOT suppressed"


@query(f"SELECT id, email, export_batch FROM contacts WHERE {DAILY} ORDER BY export_batch ASC NULLS LAST, id LIMIT 25")
def daily_selection(contacts):
    return read.daily_selection(contacts).select("id", "email", "export_batch")


@query(f"SELECT id, email, export_batch FROM (SELECT *, row_number() OVER (PARTITION BY email_domain ORDER BY export_batch ASC NULLS LAST, id) AS k FROM contacts WHERE {DAILY}) AS r WHERE k <= 2 ORDER BY export_batch ASC NULLS LAST, id LIMIT 25")
def daily_selection_domain_cap(contacts):
    return read.daily_selection(contacts, per_domain=2).select("id", "email", "export_batch")


@query("SELECT id, ooo_at FROM contacts WHERE ooo_at IS NOT NULL AND cm_status = 'not_found'")
def followup_cohort(contacts):
    return read.followup_cohort(contacts).select("id", "ooo_at")


@query("SELECT strftime(timezone('Australia/Melbourne', timezone('UTC', occurred_at)), '%Y-%m-%d') AS day, " + ", ".join(f"count(*) FILTER (event = '{e}') AS {e}" for e in read.EVENTS) + " FROM send_events GROUP BY 1")
def sends_by_day(send_events):
    return read.sends_by_day(send_events)


@query(
    "SELECT *, CASE WHEN sent = 0 THEN 'no-sends' WHEN complaint_rate >= 0.0005 OR bounce_rate >= 0.03 THEN 'stop' WHEN bounce_rate >= 0.02 THEN 'warn' ELSE 'ok' END AS status "
    "FROM (SELECT *, CAST(bounced AS DOUBLE) / nullif(sent, 0) AS bounce_rate, CAST(complained AS DOUBLE) / nullif(sent, 0) AS complaint_rate FROM "
    "(SELECT count(*) FILTER (event = 'sent') AS sent, count(*) FILTER (event = 'bounced') AS bounced, count(*) FILTER (event = 'complained') AS complained FROM send_events) AS t) AS r"
)
def sends_status(send_events):
    return read.sends_status(send_events)


@query(
    f"SELECT export_batch, count(*) AS n, count(*) FILTER (proximity_tier = 'dealer') AS n_dealer, count(*) FILTER (proximity_tier = 'T1') AS n_t1, count(*) FILTER (proximity_tier = 'T2') AS n_t2, count(*) FILTER (proximity_tier = 'T3') AS n_t3, "
    f"count(*) FILTER (regexp_matches(lower(split_part(coalesce(email, ''), '@', 1)), '{ROLE_INBOX}')) AS n_role, count(DISTINCT email_domain) AS domains, max(same) AS most_of_a_domain "
    "FROM (SELECT *, count(*) OVER (PARTITION BY export_batch, email_domain) AS same FROM contacts WHERE export_batch IS NOT NULL) AS r GROUP BY export_batch"
)
def batch_composition(contacts):
    return read.batch_composition(contacts)


# ---- scalars


@query(f"SELECT id, {case_of('lower(trim(role_raw))', vocab.ROLES)} AS role FROM contacts")
def role_normalise(contacts):
    return contacts.select("id", S.role_normalised(F.col("role_raw")).alias("role"))


_EITHER = "|".join(vocab.ROLE_KEYWORDS)


@query(f"SELECT id, coalesce(regexp_matches(lower(trim(role_raw)), '^({_EITHER})|[-/&,]\\s*({_EITHER})'), false) AS plausible FROM contacts")
def role_plausible(contacts):
    return contacts.select("id", S.role_plausible(F.col("role_raw")).alias("plausible"))


@query(
    "SELECT name, CASE WHEN len(words) >= 2 THEN array_to_string(list_sort(words), ' ') ELSE '' END AS key FROM "
    "(SELECT name, list_filter(regexp_split_to_array(regexp_replace(lower(name), '[^a-z ]', ' ', 'g'), ' +'), lambda w: length(w) > 1) AS words FROM subscriber_states) AS r"
)
def name_key(subscriber_states):
    return subscriber_states.select("name", S.name_key(F.col("name")).alias("key"))


BAND = "CASE WHEN lower(coalesce(email_domain, '')) LIKE '%.au' THEN 'AU' WHEN length(split_part(lower(coalesce(email_domain, '')), '.', -1)) = 2 THEN 'INTL' ELSE 'COM' END"


@query(f"SELECT id, {BAND} AS band FROM contacts")
def geo_band(contacts):
    return contacts.select("id", S.geo_band(F.col("email_domain")).alias("band"))


@query(f"SELECT id, regexp_matches(lower(split_part(coalesce(email, ''), '@', 1)), '{ROLE_INBOX}') AS role_inbox FROM contacts")
def role_inbox(contacts):
    return contacts.select("id", S.is_role_inbox(F.col("email")).alias("role_inbox"))


def _overlap(table: list[str]) -> str:
    return f"len(list_intersect(words, [{', '.join(repr(v) for v in table)}])) > 0"


@query(
    f"SELECT id, CASE WHEN source = 'team_page' THEN 'dealer' WHEN coalesce(email_domain, '') = '' THEN 'T4' WHEN {among('lower(email_domain)', vocab.FREEMAIL)} THEN 'T4' "
    f"WHEN {among('lower(email_domain)', vocab.IMPORTERS)} OR {_overlap(vocab.MAKERS)} THEN 'T1' WHEN {among('lower(email_domain)', vocab.BODIES)} OR {_overlap(vocab.SUPPLIERS)} THEN 'T2' WHEN {_overlap(vocab.AGENCIES)} THEN 'T3' ELSE 'T4' END AS tier "
    "FROM (SELECT *, regexp_extract_all(lower(email_domain), '[a-z0-9]+') AS words FROM contacts) AS r"
)
def proximity_tier(contacts):
    return contacts.select("id", S.proximity_tier(F.col("source"), F.col("email_domain")).alias("tier"))


@query("SELECT id, nullif(regexp_replace(regexp_extract(website_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\\.', ''), '') AS site FROM dealerships")
def site_domain(dealerships):
    return dealerships.select("id", S.site_domain(F.col("website_url")).alias("site"))


@query("SELECT id, CASE WHEN source_detail LIKE 'newspress: % — %' THEN nullif(trim(split_part(regexp_extract(source_detail, 'newspress: (.*)', 1), ' — ', 1)), '') END AS company FROM contacts")
def company_backfill(contacts):
    return contacts.select("id", S.release_company(F.col("source_detail")).alias("company"))


@query("SELECT DISTINCT domain, len(list_intersect(regexp_extract_all(domain, '[a-z0-9]+'), ['fleet', 'hub', 'ford'])) > 0 AS hit FROM (SELECT email_domain AS domain FROM contacts WHERE email_domain IS NOT NULL) AS r")
def token_overlap(contacts):
    words = F.array(F.lit("fleet"), F.lit("hub"), F.lit("ford"))
    return contacts.filter("email_domain is not null").select(F.col("email_domain").alias("domain"), F.arrays_overlap(S.domain_words(F.col("email_domain")), words).alias("hit")).distinct()


# ---- states

KEPT = "id, suppressed, suppress_reason"


@query("SELECT c.id, CASE WHEN c.email IS NULL THEN cm_status ELSE coalesce(state, 'not_found') END AS cm_status FROM contacts AS c LEFT JOIN (SELECT lower(email) AS email, arg_max(state, CASE state WHEN 'active' THEN 3 WHEN 'unsubscribed' THEN 2 ELSE 1 END) AS state FROM subscriber_states WHERE list_name NOT LIKE 'Campaign-%' GROUP BY 1) AS s ON lower(c.email) = s.email")
def subscriber_stamp(contacts, subscriber_states):
    return state.subscriber_stamp(contacts, subscriber_states).select("id", "cm_status")


@query("SELECT id, CASE WHEN hit THEN 'ruled_out' ELSE disposition END AS disposition, CASE WHEN hit THEN 'wp-member' ELSE ruled_out_stage END AS ruled_out_stage FROM (SELECT *, lower(email) IN (SELECT lower(trim(email)) FROM accounts) AND email IS NOT NULL AND disposition = 'in_play' AS hit FROM contacts) AS r")
def account_ruleout(contacts, accounts):
    return state.account_ruleout(contacts, accounts).select("id", "disposition", "ruled_out_stage")


BLOCKED = ["bosch.test", "havas.example.com"]


@query(f"SELECT id, suppressed OR coalesce({among('email_domain', BLOCKED)}, false) AS suppressed, CASE WHEN {among('email_domain', BLOCKED)} THEN 'media_domain' ELSE suppress_reason END AS suppress_reason FROM contacts")
def domain_suppress(contacts):
    return state.suppress_domains(contacts, BLOCKED).select(*KEPT.split(", "))


@query("SELECT id, suppressed OR hit AS suppressed, CASE WHEN hit THEN 'verify:' || verify_status ELSE suppress_reason END AS suppress_reason FROM (SELECT *, coalesce(verify_status IN ('dead_domain', 'undeliverable', 'bad_syntax'), false) AND NOT suppressed AS hit FROM contacts) AS r")
def undeliverable_suppress(contacts):
    return state.suppress_undeliverable(contacts).select(*KEPT.split(", "))


@query("SELECT id, suppressed OR coalesce(id % 50 = 1 OR lower(email) LIKE 'wren%', false) AS suppressed, CASE WHEN coalesce(id % 50 = 1 OR lower(email) LIKE 'wren%', false) THEN 'left_employer' ELSE suppress_reason END AS suppress_reason FROM contacts")
def stale_flag(contacts):
    return state.flag_stale(contacts, (F.col("id") % 50 == 1) | F.lower("email").startswith("wren")).select(*KEPT.split(", "))


@query("SELECT id, suppressed AND NOT hit AS suppressed, CASE WHEN NOT hit THEN suppress_reason END AS suppress_reason FROM (SELECT *, coalesce(id % 3 = 0 AND suppress_reason = 'left_employer', false) AS hit FROM contacts) AS r")
def stale_unflag(contacts):
    return state.flag_stale(contacts, F.col("id") % 3 == 0, undo=True).select(*KEPT.split(", "))


_DERIVED = among("ruled_out_stage", state.DERIVED)


@query(
    "SELECT id, coalesce(company, dealer, CASE WHEN source = 'newspress' AND source_detail LIKE 'newspress: % — %' THEN nullif(trim(split_part(regexp_extract(source_detail, 'newspress: (.*)', 1), ' — ', 1)), '') END) AS company, "
    "CASE WHEN off OR cm THEN 'ruled_out' WHEN back THEN 'in_play' ELSE disposition END AS disposition, "
    "CASE WHEN off THEN 'suppressed' WHEN cm THEN 'cm-' || cm_status WHEN back THEN NULL ELSE ruled_out_stage END AS ruled_out_stage, "
    "CASE WHEN off THEN coalesce(suppress_reason, 'suppressed') WHEN cm THEN CASE cm_status " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in state.CM_REASONS.items()) + " END WHEN back THEN NULL ELSE ruled_out_reason END AS ruled_out_reason "
    f"FROM (SELECT c.*, d.name AS dealer, suppressed AND (ruled_out_stage IS NULL OR {_DERIVED}) AS off, NOT suppressed AND coalesce(cm_status IN ('active', 'unsubscribed', 'deleted'), false) AND (ruled_out_stage IS NULL OR {_DERIVED}) AS cm, "
    f"disposition = 'ruled_out' AND NOT suppressed AND (cm_status IS NULL OR cm_status = 'not_found') AND coalesce({_DERIVED}, false) AS back FROM contacts AS c LEFT JOIN (SELECT id AS d_id, name FROM dealerships) AS d ON c.dealership_id = d.d_id) AS r"
)
def ledger_refresh(contacts, dealerships):
    return state.ledger_refresh(contacts, dealerships).select("id", "company", "disposition", "ruled_out_stage", "ruled_out_reason")


@query(
    "WITH rows_ AS (SELECT id, lower(split_part(email, '@', 1)) AS local, lower(email_domain) AS domain, lower(full_name) AS name, export_batch FROM contacts WHERE email IS NOT NULL AND NOT suppressed "
    f"AND regexp_matches(split_part(email, '@', 1), '^[a-z]+[._][a-z]+$') AND NOT regexp_matches(split_part(email, '@', 1), '{vocab.SHARED_WORDS}') AND regexp_matches(coalesce(full_name, ''), '^[A-Za-z]+ +[A-Za-z]')), "
    "groups_ AS (SELECT local FROM rows_ GROUP BY local HAVING count(DISTINCT domain) BETWEEN 2 AND 4 AND count(DISTINCT name) = 1) "
    "SELECT id, local, domain, row_number() OVER (PARTITION BY local ORDER BY CASE WHEN domain LIKE '%.au' THEN 0 ELSE 1 END, CASE WHEN contains(domain, 'marketing') THEN 1 ELSE 0 END, export_batch ASC NULLS LAST, id) = 1 AS keep FROM rows_ JOIN groups_ USING (local)"
)
def cross_domain_dupes(contacts):
    return state.cross_domain_duplicates(contacts)


_RECENT_BATCH = (
    f"SELECT id FROM (SELECT *, array_to_string(list_sort(list_filter(regexp_split_to_array(regexp_replace(lower(first_name || ' ' || last_name), '[^a-z ]', ' ', 'g'), ' +'), lambda w: length(w) > 1)), ' ') AS k FROM contacts) AS r "
    f"WHERE source = 'newspress' AND NOT suppressed AND disposition = 'in_play' AND cm_status = 'not_found' AND (verify_status IS NULL OR NOT {among('verify_status', read.HEALTH_EXCLUDED)}) AND source_date >= {AS_OF} - INTERVAL 12 MONTH "
    "AND k NOT IN (SELECT array_to_string(list_sort(list_filter(regexp_split_to_array(regexp_replace(lower(name), '[^a-z ]', ' ', 'g'), ' +'), lambda w: length(w) > 1)), ' ') FROM subscriber_states WHERE state = 'active')"
)


@query(_RECENT_BATCH)
def recent_batch_antijoin(contacts, subscriber_states):
    names = subscriber_states.filter("state = 'active'").select(S.name_key(F.col("name")).alias("name_key"))
    return read.recent_batch(contacts, names, F.expr(AS_OF)).select("id")


@query("SELECT c.id, c.email, mail_id, sent_on FROM (SELECT id, email FROM contacts WHERE email IS NOT NULL) AS c JOIN archive_whole AS a ON contains(lower(to_header), c.email) WHERE is_outgoing AND body ILIKE '%the marker%'")
def preflight_matches_whole(contacts, archive_whole):
    return read.preflight_matches(contacts.filter("email is not null"), archive_whole, "the marker")


@query(
    f"SELECT id, suppressed OR b AS suppressed, CASE WHEN b THEN 'bounce' ELSE ruled_out_stage END AS ruled_out_stage, CASE WHEN b THEN 'ruled_out' ELSE disposition END AS disposition, CASE WHEN kind = 'ooo' AND ooo_at IS NULL THEN coalesce(evdate, {AS_OF}) ELSE ooo_at END AS ooo_at "
    "FROM (SELECT c.*, kind, evdate, coalesce(kind = 'bounce', false) AND ruled_out_stage IS DISTINCT FROM 'bounce' AS b FROM contacts AS c LEFT JOIN (SELECT email AS s_email, kind, evdate FROM sweep) AS s ON lower(c.email) = s_email) AS r"
)
def sweep_reconcile(contacts, sweep):
    return state.sweep_reconcile(contacts, sweep, F.expr(AS_OF)).select("id", "suppressed", "ruled_out_stage", "disposition", "ooo_at")


@query(f"SELECT id FROM contacts WHERE NOT (email IS NULL AND ({among('lower(trim(full_name))', vocab.LABELS)} OR regexp_matches(lower(trim(full_name)), '" + "|".join(f"({p})" for p in vocab.DEPARTMENTS) + "')))")
def label_cleanup(contacts):
    return state.cleanup_labels(contacts).select("id")


# ---- keyed writes: the table's rows with even ids are old, the others are new, on the key of name and suburb

_OLD = "SELECT brand_slug, suburb, api_email, id FROM dealerships WHERE id % 2 = 0"
_NEW = "SELECT brand_slug, suburb, api_email, id FROM dealerships WHERE id % 2 = 1"
_KEYS = ["brand_slug", "suburb"]


def _halves(dealerships):
    rows = dealerships.select("brand_slug", "suburb", "api_email", "id")
    return state.first_of(rows.filter("id % 2 = 0"), _KEYS, [F.col("id")]), rows.filter("id % 2 = 1")


_FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand_slug, suburb ORDER BY id) AS k FROM ({0}) AS x) AS y WHERE k = 1 OR suburb IS NULL)"


@query(f"SELECT brand_slug, suburb, api_email, id FROM {_FIRST.format(_OLD)} AS o UNION ALL SELECT brand_slug, suburb, api_email, id FROM {_FIRST.format(_NEW)} AS n WHERE NOT EXISTS (SELECT 1 FROM ({_OLD}) AS o WHERE o.brand_slug = n.brand_slug AND o.suburb = n.suburb)")
def upsert_ignore(dealerships):
    old, new = _halves(dealerships)
    return state.insert_ignore(old, new, _KEYS, [F.col("id")])


def _upsert_sql(email: str, number: str) -> str:
    return (
        f"SELECT coalesce(o.brand_slug, n.brand_slug) AS brand_slug, coalesce(o.suburb, n.suburb) AS suburb, CASE WHEN o.id IS NOT NULL AND n.id IS NOT NULL THEN {email} WHEN o.id IS NOT NULL THEN o.api_email ELSE n.api_email END AS api_email, "
        f"CASE WHEN o.id IS NOT NULL AND n.id IS NOT NULL THEN {number} ELSE coalesce(o.id, n.id) END AS id, o.id IS NULL AS inserted FROM {_FIRST.format(_OLD)} AS o FULL JOIN {_FIRST.format(_NEW)} AS n ON o.brand_slug = n.brand_slug AND o.suburb = n.suburb"
    )


@query(_upsert_sql("coalesce(o.api_email, n.api_email)", "o.id"))
def upsert_fill_null(dealerships):
    old, new = _halves(dealerships)
    return state.upsert(old, new, _KEYS, [F.col("id")], state.fill_null("api_email"))


@query(_upsert_sql("o.api_email", "greatest(o.id, n.id)"))
def upsert_greatest(dealerships):
    old, new = _halves(dealerships)
    return state.upsert(old, new, _KEYS, [F.col("id")], state.greatest_of("id"))


@query(_upsert_sql("CASE WHEN contains(o.api_email, '.au') THEN n.api_email ELSE o.api_email END", "o.id"))
def upsert_replace_if(dealerships):
    old, new = _halves(dealerships)
    return state.upsert(old, new, _KEYS, [F.col("id")], state.replace_if("api_email", lambda o: F.contains(o, F.lit(".au"))))


@query(_upsert_sql("n.api_email", "n.id"))
def upsert_overwrite(dealerships):
    old, new = _halves(dealerships)
    return state.upsert(old, new, _KEYS, [F.col("id")], state.prefer_new)


@query("SELECT id, CASE WHEN id % 10 = 0 THEN 'T9' ELSE proximity_tier END AS proximity_tier FROM contacts")
def bulk_update_by_id(contacts):
    return state.update_by_id(contacts, contacts.filter("id % 10 = 0").select("id", F.lit("T9").alias("proximity_tier")), "proximity_tier").select("id", "proximity_tier")


@query("SELECT id, CASE scrape_state WHEN 'discovered' THEN CASE WHEN website_url IS NULL THEN 'no_team_page' ELSE 'team_found' END ELSE scrape_state END AS scrape_state FROM dealerships")
def scrape_transition(dealerships):
    return state.scrape_transition(dealerships).select("id", "scrape_state")


# ---- verification

_PROVIDER = case_of("h", vocab.GATEWAYS, "CASE WHEN contains(h, 'secureserver') THEN 'GoDaddy' WHEN " + " OR ".join(f"contains(h, '{k}')" for k in vocab.SMALL_HOSTS) + " THEN 'cPanel-ish' ELSE 'other/self' END")
_HOSTS = "(SELECT domain, lower(string_agg(host, ' ' ORDER BY preference, host)) AS h, arg_min(host, struct_pack(p := preference, x := host)) AS top FROM mx_records GROUP BY domain)"


@query(
    f"SELECT id, CASE WHEN h IS NULL THEN 'dead_domain' WHEN {among('local', vocab.VERIFY_ROLES)} THEN 'role' WHEN provider IN ('Google', 'Microsoft365', 'Mimecast', 'Proofpoint', 'Symantec') THEN 'unknown_gateway' ELSE 'unknown' END AS verify_status, provider AS verify_provider, top AS verify_mx "
    f"FROM (SELECT c.id, split_part(email, '@', 1) AS local, h, top, CASE WHEN h IS NULL THEN 'dead' ELSE {_PROVIDER} END AS provider FROM contacts AS c LEFT JOIN {_HOSTS} AS m ON m.domain = c.email_domain WHERE email IS NOT NULL) AS r"
)
def mx_verdict(contacts, mx_records):
    return people.verify_by_dns(contacts, mx_records)


_RCPT = "CASE WHEN catchall_code IN (250, 251) THEN 'catchall' WHEN code IN (250, 251) THEN 'deliverable' WHEN code IN (550, 551, 553) THEN 'undeliverable' ELSE 'unknown' END"


@query(f"SELECT id, {_RCPT} AS verify_status, catchall_code IN (250, 251) AS verify_catchall FROM contacts JOIN rcpt_results ON address = email WHERE NOT suppressed")
def rcpt_verdict(contacts, rcpt_results):
    return people.verify_by_probe(contacts, rcpt_results)


@query(f"SELECT email_domain, top AS verify_mx, array_to_string(list(id ORDER BY id), ',') AS ids, array_to_string(list(email ORDER BY id), ',') AS emails FROM contacts JOIN {_HOSTS} AS m ON m.domain = email_domain GROUP BY 1, 2")
def probe_groups(contacts, mx_records):
    hosts = people.mx_hosts(mx_records).select(F.col("domain").alias("email_domain"), F.get("hosts", F.lit(0)).alias("verify_mx"))
    return people.probe_groups(contacts.join(hosts, "email_domain")).withColumns({"ids": F.array_join("ids", ","), "emails": F.array_join("emails", ",")})


# ---- addresses

_PATTERN = "CASE WHEN dots * 2 > n THEN 'first.last' WHEN lines * 2 > n THEN 'first_last' WHEN plain >= 2 THEN CASE WHEN mean > 5 THEN 'flast' ELSE 'first' END END"


@query(
    f"WITH e AS (SELECT email_domain AS grp, seq, address, split_part(address, '@', 2) AS domain, split_part(address, '@', 1) AS own FROM (SELECT *, split_part(address, '@', 2) AS email_domain FROM senders) AS s), "
    f"top AS (SELECT grp, domain FROM (SELECT grp, domain, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, min(seq)) AS k FROM e WHERE NOT {among('domain', vocab.FREEMAIL)} GROUP BY grp, domain) AS t WHERE k = 1) "
    f"SELECT grp, domain, {_PATTERN} AS pattern FROM (SELECT grp, domain, count(*) AS n, count(*) FILTER (contains(own, '.')) AS dots, count(*) FILTER (contains(own, '_')) AS lines, count(*) FILTER (p) AS plain, avg(length(own)) FILTER (p) AS mean "
    "FROM (SELECT *, regexp_matches(own, '^[a-z]+$') AND length(own) > 2 AS p FROM e JOIN top USING (grp, domain)) AS x GROUP BY grp, domain) AS y"
)
def pattern_inference(senders):
    rows = senders.select(S.domain_part(F.col("address")).alias("grp"), "seq", F.col("address").alias("email"))
    return people.infer_patterns(rows, "grp").select("grp", "domain", "pattern")


_FORMS = ["first.last", "first_last", "flast", "first", "firstl", "lastf", "last.first", "firstlast"]
_LOCAL = "CASE id % 8 WHEN 0 THEN f || '.' || l WHEN 1 THEN f || '_' || l WHEN 2 THEN substr(f, 1, 1) || l WHEN 3 THEN f WHEN 4 THEN f || substr(l, 1, 1) WHEN 5 THEN l || substr(f, 1, 1) WHEN 6 THEN l || '.' || f ELSE f || l END"


@query(f"SELECT id, {_LOCAL} || '@' || domain AS email, 'inferred' AS confidence FROM (SELECT id, lower(first_name) AS f, lower(last_name) AS l, coalesce(email_domain, 'a.test') AS domain FROM contacts) AS r")
def address_generation(contacts):
    pattern = F.get(F.array(*map(F.lit, _FORMS)), (F.col("id") % 8).cast("int"))
    rows = contacts.select("id", "first_name", "last_name", pattern.alias("pattern"), F.coalesce("email_domain", F.lit("a.test")).alias("domain"))
    return people.generate_addresses(rows).select("id", "email", "confidence")


@query(
    "WITH p AS (SELECT id, email_domain AS grp, lower(first_name) AS f, lower(last_name) AS l FROM contacts WHERE email_domain IS NOT NULL), "
    "t AS (SELECT id, grp, unnest([f || '.' || l, substr(f, 1, 1) || l, f, f || substr(l, 1, 1), l || '.' || f, l || substr(f, 1, 1), f || '_' || l, f || l]) AS local, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS turn FROM p) "
    "SELECT id, arg_min(address, struct_pack(a := turn, b := address)) AS email FROM t JOIN (SELECT address, split_part(address, '@', 1) AS local, split_part(address, '@', 2) AS grp FROM senders) AS s USING (grp, local) GROUP BY id"
)
def prefix_match(contacts, senders):
    known = senders.select(S.domain_part(F.col("address")).alias("grp"), F.col("address").alias("email"))
    return people.match_known(contacts.filter("email_domain is not null").select("id", F.col("email_domain").alias("grp"), "first_name", "last_name"), known, "grp")


@query(
    "WITH s AS (SELECT seq, split_part(address, '@', 2) AS domain, lower(split_part(address, '@', 1)) AS own, address, lower(split_part(display_name, ' ', 1)) AS f, lower(split_part(display_name, ' ', -1)) AS l FROM senders), "
    "d AS (SELECT *, CASE own WHEN f || '.' || l THEN 'first.last' WHEN f || '_' || l THEN 'first_last' WHEN substr(f, 1, 1) || l THEN 'flast' WHEN f || substr(l, 1, 1) THEN 'firstl' WHEN f || l THEN 'firstlast' WHEN l || '.' || f THEN 'last.first' WHEN l || substr(f, 1, 1) THEN 'lastf' END AS form FROM s) "
    "SELECT domain, form AS pattern, sample_email, sender_count, pattern_count FROM (SELECT domain, form, arg_min(address, seq) AS sample_email, count(*) AS pattern_count, row_number() OVER (PARTITION BY domain ORDER BY count(*) DESC, min(seq)) AS k FROM d WHERE form IS NOT NULL GROUP BY domain, form) AS x JOIN (SELECT domain, count(*) AS sender_count FROM d GROUP BY domain) AS y USING (domain) WHERE k = 1"
)
def domain_format_profile(senders):
    return people.domain_formats(senders)


@query("SELECT email, 'direct' AS confidence FROM contacts WHERE email IS NOT NULL UNION ALL SELECT address AS email, 'inferred' AS confidence FROM senders WHERE NOT EXISTS (SELECT 1 FROM contacts WHERE email = address)")
def published_over_derived_whole(contacts, senders):
    return people.published_over_derived(contacts.filter("email is not null").select("email"), senders.select(F.col("address").alias("email")))


@query("SELECT state, lower(email) AS email FROM subscriber_states WHERE list_name NOT LIKE 'Campaign-%' GROUP BY 1, 2")
def union_states(subscriber_states):
    rows = subscriber_states.filter(~F.col("list_name").startswith("Campaign-")).select("state", F.lower("email").alias("email"))
    return rows.distinct()


# ---- text


@query(f"SELECT DISTINCT doc_id, email FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{vocab.EMAIL}')) AS email FROM documents) AS r WHERE NOT regexp_matches(email, '\\.(png|jpg|svg)$')")
def email_extract_documents(documents):
    return html.emails_in_text(documents, "doc_id")


@query()
def email_extract_pages(pages):
    return html.emails_of_pages(html.parse_pages(pages, parts=("text", "mailtos")))


_PLUMBING = "|".join(d.replace(".", r"\.") for d in vocab.INFRASTRUCTURE)


@query(
    f"SELECT id, CASE WHEN NOT ({among('d', vocab.INFRASTRUCTURE)} OR regexp_matches(d, '\\.({_PLUMBING})$')) THEN CASE WHEN {among('l', vocab.GENERIC_LOCALS)} OR regexp_matches(l, '" + "|".join(f"({p})" for p in vocab.GENERIC_PATTERNS) + "') THEN 'generic' ELSE 'person' END END AS kind "
    "FROM (SELECT id, split_part(email, '@', 2) AS d, split_part(email, '@', 1) AS l FROM contacts WHERE email IS NOT NULL) AS r"
)
def email_generic_split(contacts):
    return contacts.filter("email is not null").select("id", html.email_kind(F.col("email")).alias("kind"))


@query()
def link_scores(pages):
    return html.link_scores(html.parse_pages(pages, parts=("links",)))


@query()
def people_cards(pages):
    return html.card_people(html.parse_pages(pages, parts=("content", "headings")))


@query()
def jsonld_people(pages):
    return html.jsonld_people(html.parse_pages(pages, parts=("people",)))


def _as_mail(documents):
    """Documents as raw messages: a header of each kind in turn."""
    head = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Subject: Undeliverable: hello\nFrom: postmaster@a.test\n\nFinal-Recipient: rfc822; u"), "doc_id", F.lit("@a.test\n"))).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("Subject: Out of office\nAuto-Submitted: auto-replied\nDate: Mon, 01 Jan 2024 10:00:00 +0000\nFrom: U <u"), "doc_id", F.lit("@b.test>\n\n"))).otherwise(F.lit("Subject: Re: lunch\nFrom: c@d.test\n\n"))
    return documents.select(F.col("doc_id").alias("msg_id"), F.concat(head, "text").alias("raw"))


@query(
    "SELECT doc_id AS msg_id, CASE doc_id % 5 WHEN 0 THEN 'bounce' WHEN 1 THEN 'ooo' END AS kind, CASE doc_id % 5 WHEN 0 THEN 'u' || CAST(doc_id AS VARCHAR) || '@a.test' WHEN 1 THEN 'u' || CAST(doc_id AS VARCHAR) || '@b.test' END AS email, CASE WHEN doc_id % 5 = 1 THEN DATE '2024-01-01' END AS evdate FROM documents"
)
def mail_classify(documents):
    return mail.classify(mail.parse_messages(_as_mail(documents), body=False))


@query()
def reply_harvest(documents):
    return mail.harvest_replies(mail.parse_messages(_as_mail(documents)))


@query()
def mime_body(documents):
    return mail.parse_messages(_as_mail(documents)).select("msg_id", F.length("body").alias("n"), F.sha2("body", 256).alias("sha256"))


@query("SELECT release_id, n3 AS name, 'Sales Manager' AS role FROM release_mails WHERE kind <> 2")
def appointments(releases):
    return mail.appointments(release.read_releases(releases, ("title",)).select("release_id", "title", F.col("text").alias("body")))


# ---- locators

_CARDS, _SILENT = "brand_slug IN ('ford', 'audi', 'volvo')", "'mitsubishi', 'honda', 'mercedes', 'jeep', 'mg', 'byd'"


@query(f"""SELECT brand_slug, seq, CASE WHEN {_CARDS} THEN upper(substr(brand_slug, 1, 1)) || substr(brand_slug, 2) || ' ' || name ELSE name END AS name,
  CASE WHEN {_CARDS} THEN NULL WHEN brand_slug = 'kia' THEN address || ', ' || postcode WHEN brand_slug = 'mg' THEN address || ', ' || suburb || ' ' || state || ' ' || postcode ELSE address END AS address,
  CASE WHEN NOT {_CARDS} THEN suburb END AS suburb, state, CASE WHEN ({_CARDS} OR brand_slug = 'kia') AND s_suppkey BETWEEN 1000 AND 9999 THEN CAST(s_suppkey AS STRING) ELSE postcode END AS postcode,
  CASE WHEN brand_slug <> 'byd' THEN phone END AS phone,
  CASE WHEN NOT {_CARDS} AND brand_slug <> 'gwm' THEN website_url END AS website_url,
  CASE WHEN NOT {_CARDS} AND brand_slug NOT IN ({_SILENT}) THEN lower(api_email) END AS api_email FROM locator_facts""".replace("AS STRING", "AS VARCHAR"))
def locator_projects(locator_payloads):
    """All brands, each by its own mapping."""
    return locators.project_all(locator_payloads)


_SCHEMA = "dealer struct<code:string,name:string,state:string>, departments array<struct<phone:string,email:string>>, address string"


def _entries(locator_raw):
    return locator_raw.select("brand_slug", "seq", F.from_json("payload_json", _SCHEMA).alias("e"))


@query("SELECT brand_slug, seq, nullif(trim(json_extract_string(payload_json, '$.dealer.name')), '') AS name, nullif(trim(json_extract_string(payload_json, '$.address')), '') AS address FROM locator_raw")
def locator_json_project(locator_raw):
    return _entries(locator_raw).select("brand_slug", "seq", locators.text("e.dealer.name").alias("name"), locators.text("e.address").alias("address"))


@query("SELECT seq, json_extract_string(payload_json, '$.departments[1].phone') AS phone, json_extract_string(payload_json, '$.departments[1].email') AS email FROM locator_raw")
def locator_first_nonempty(locator_raw):
    return _entries(locator_raw).select("seq", locators.first_nonempty("e.departments", "phone").alias("phone"), locators.first_nonempty("e.departments", "email", "@").alias("email"))


@query("SELECT seq, CASE s " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in locators.STATES.items()) + " ELSE r END AS state FROM (SELECT seq, CASE WHEN seq % 2 = 0 THEN 'Victoria ' ELSE json_extract_string(payload_json, '$.dealer.state') END AS r, lower(trim(CASE WHEN seq % 2 = 0 THEN 'Victoria ' ELSE json_extract_string(payload_json, '$.dealer.state') END)) AS s FROM locator_raw) AS x")
def locator_state_map(locator_raw):
    raw = F.when(F.col("seq") % 2 == 0, "Victoria ").otherwise(F.col("e.dealer.state"))
    return _entries(locator_raw).select("seq", locators.state_of(raw).alias("state"))


@query(r"SELECT seq, regexp_extract(a, '^(.*?\bRoad\b),?\s+(.*?),?\s+([A-Z]{2,3})\s+(\d{4})', 1) AS address, regexp_extract(a, '^(.*?\bRoad\b),?\s+(.*?),?\s+([A-Z]{2,3})\s+(\d{4})', 2) AS suburb, 'VIC' AS state, regexp_extract(a, '(\d{4})$', 1) AS postcode FROM (SELECT seq, json_extract_string(payload_json, '$.address') AS a FROM locator_raw) AS r")
def address_regex_parse(locator_raw):
    got = locators.address_by_regex(F.col("e.address"))
    return _entries(locator_raw).select("seq", *[c.alias(n) for n, c in got.items()])


@query("SELECT seq, split_part(a, ', ', 1) AS address, split_part(a, ', ', 2) AS suburb, 'VIC' AS state, split_part(a, ' ', -1) AS postcode FROM (SELECT seq, json_extract_string(payload_json, '$.address') AS a FROM locator_raw) AS r")
def address_comma_parse(locator_raw):
    got = locators.address_by_commas(F.col("e.address"))
    return _entries(locator_raw).select("seq", *[c.alias(n) for n, c in got.items()])


@query("SELECT code, min(seq) AS seq FROM (SELECT json_extract_string(payload_json, '$.dealer.code') AS code, seq FROM locator_raw) AS r GROUP BY code")
def first_wins_dedupe(locator_raw):
    rows = _entries(locator_raw).select(F.col("e.dealer.code").alias("code"), "seq")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("seq"))).filter("n = 1").select("code", "seq")


# ---- releases

_RELEASES = "(SELECT id AS release_id, id % 20 AS client, source_date AS release_date, id AS list_pos FROM contacts) AS r"


@query(f"SELECT release_id FROM (SELECT *, max(CASE WHEN release_date < DATE '2022-03-01' THEN 1 ELSE 0 END) OVER (PARTITION BY client ORDER BY list_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS old FROM {_RELEASES}) AS s WHERE old = 0")
def release_scan_until_older(contacts):
    rows = contacts.select(F.col("id").alias("release_id"), (F.col("id") % 20).alias("client"), F.col("source_date").alias("release_date"), F.col("id").alias("list_pos"))
    return release.until_older(rows, "client", F.expr("DATE '2022-03-01'")).select("release_id")


@query("SELECT address AS email, source_date, full_name, seq FROM (SELECT address, max(source_date) AS source_date, arg_min(full_name, seq) AS full_name, min(seq) AS seq FROM (SELECT split_part(address, '@', 2) AS address, seq, display_name AS full_name, DATE '2022-01-01' + CAST(seq % 700 AS INT) AS source_date FROM senders) AS x GROUP BY address) AS y")
def latest_captures(senders):
    rows = senders.select(S.domain_part(F.col("address")).alias("email"), "seq", F.col("display_name").alias("full_name"), F.expr("DATE '2022-01-01' + CAST(seq % 700 AS INT)").alias("source_date"))
    return release.latest_captures(rows)


_SITE_SQL = "lower(nullif(regexp_replace(regexp_extract(website_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\\.', ''), ''))"


def _patterns_sql(rows: str) -> str:
    """(grp, domain, pattern) of rows (grp, email, seq)."""
    return (
        f"SELECT grp, domain, {_PATTERN} AS pattern FROM (SELECT grp, domain, count(*) AS n, count(*) FILTER (contains(own, '.')) AS dots, count(*) FILTER (contains(own, '_')) AS lines, count(*) FILTER (p) AS plain, avg(length(own)) FILTER (p) AS mean FROM "
        f"(SELECT grp, domain, split_part(email, '@', 1) AS own, regexp_matches(split_part(email, '@', 1), '^[a-z]+$') AND length(split_part(email, '@', 1)) > 2 AS p FROM (SELECT *, split_part(email, '@', 2) AS domain FROM ({rows}) AS a) AS b JOIN "
        f"(SELECT grp, domain FROM (SELECT grp, split_part(email, '@', 2) AS domain, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, min(seq)) AS k FROM ({rows}) AS c GROUP BY 1, 2) AS d WHERE k = 1) AS e USING (grp, domain)) AS f GROUP BY grp, domain) AS g"
    )


@query(
    f"WITH one AS ({_patterns_sql('SELECT dealership_id AS grp, email, id AS seq FROM contacts WHERE email IS NOT NULL AND dealership_id IS NOT NULL')}), two AS ({_patterns_sql('SELECT email_domain AS grp, email, id AS seq FROM contacts WHERE email IS NOT NULL')}), "
    f"p AS (SELECT c.id, lower(first_name) AS f, lower(last_name) AS l, coalesce(one.pattern, two.pattern) AS pattern, CASE WHEN one.pattern IS NOT NULL THEN one.domain ELSE two.domain END AS domain FROM contacts AS c JOIN (SELECT id AS d_id, {_SITE_SQL} AS site FROM dealerships) AS d ON d_id = dealership_id "
    "LEFT JOIN one ON one.grp = dealership_id AND one.pattern IS NOT NULL LEFT JOIN two ON two.grp = site AND two.pattern IS NOT NULL WHERE c.email IS NULL), "
    "m AS (SELECT id, pattern, CASE pattern WHEN 'first.last' THEN f || '.' || l WHEN 'first_last' THEN f || '_' || l WHEN 'flast' THEN substr(f, 1, 1) || l WHEN 'first' THEN f END || '@' || domain AS email FROM p) "
    "SELECT id, email, 'inferred' AS confidence, pattern FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY id) AS k FROM m WHERE email IS NOT NULL) AS x WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM contacts AS c WHERE c.email = x.email)"
)
def cross_dealer_patterns(contacts, dealerships):
    return release.pattern_pass(contacts, dealerships)


@query()
def release_contacts(pages):
    rows = pages.select(F.col("page_id").alias("release_id"), F.col("html").alias("content_html"))
    return release.release_contacts(rows, release.contact_tables(rows))


# ---- plans

_PLACE = "CASE " + " ".join(f"WHEN band = '{b}' AND tier = '{t}' THEN {i}" for i, (b, t) in enumerate(vocab.BAND_TIERS)) + " END"
_TIER_LABEL = "CASE tier " + " ".join(f"WHEN '{t}' THEN '{label}'" for t, label in vocab.TIER_LABELS.items()) + " END"
#: The plan as levels of recursion: a batch is a list of how many contacts it takes of each domain, in the domains' order.
#: Then a short tail is folded as far as domains allow, and a very short one swallowed.
_PLAN_SQL = f"""
WITH RECURSIVE banded AS (
  SELECT id, confidence, coalesce(email_domain, '?') AS domain, coalesce(proximity_tier, 'T4') AS tier, regexp_matches(lower(split_part(email, '@', 1)), '{vocab.ROLE_INBOX}') AS role,
    CASE WHEN lower(coalesce(email_domain, '?')) LIKE '%.au' THEN 'AU' WHEN length(regexp_replace(lower(coalesce(email_domain, '?')), '.*[.]', '')) = 2 THEN 'INTL' ELSE 'COM' END AS band
  FROM contacts WHERE email IS NOT NULL AND disposition = 'in_play' AND sent_at IS NULL AND confidence = 'direct' AND {FREE}),
pool AS (SELECT *, row_number() OVER (PARTITION BY grp, domain ORDER BY id) - 1 AS pos FROM (SELECT *, {_PLACE} + CASE WHEN role THEN 15 ELSE 0 END AS grp FROM banded) AS p WHERE grp IS NOT NULL),
dom AS (SELECT grp, domain, count(*) AS n, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, min(id)) AS d FROM pool GROUP BY grp, domain),
step AS (
  SELECT grp, 0 AS i, list(n ORDER BY d) AS lft, CAST([] AS BIGINT[]) AS taken FROM dom GROUP BY grp
  UNION ALL
  SELECT grp, i + 1, list_transform(lft, lambda x, j: x - t[j]), t FROM (
    SELECT grp, i, lft, list_transform(room, lambda x, j: least(x, level) + CASE WHEN x > level AND len(list_filter(room[1:j], lambda y: y > level)) <= goal - list_sum(list_transform(room, lambda y: least(y, level))) THEN 1 ELSE 0 END) AS t FROM (
      SELECT *, list_max(list_filter(range(0, cap + 1), lambda r: list_sum(list_transform(room, lambda y: least(y, r))) <= goal)) AS level FROM (
        SELECT *, list_transform(lft, lambda x, j: CASE WHEN x > 0 AND len(list_filter(lft[1:j], lambda y: y > 0)) <= goal THEN least(cap, x) ELSE 0 END) AS room FROM (
          SELECT *, CAST(least((i + 1) * 50, 250) AS BIGINT) AS goal, CAST(CASE WHEN i < 3 THEN 5 ELSE 10 END AS BIGINT) AS cap FROM step) AS g) AS r) AS l) AS x
  WHERE list_sum(t) > 0),
fold AS (
  SELECT grp, 0 AS s, false AS done, list(taken ORDER BY i) AS b FROM step WHERE i > 0 GROUP BY grp
  UNION ALL
  SELECT grp, s + 1, list_sum(rest) > 0, b[1:len(b) - 2] || [list_transform(b[-2], lambda x, j: x + moved[j])] || CASE WHEN list_sum(rest) > 0 THEN [rest] ELSE [] END FROM (
    SELECT *, list_transform(b[-1], lambda x, j: x - moved[j]) AS rest FROM (
      SELECT *, list_transform(b[-1], lambda x, j: least(x, greatest(0, 12 - b[-2][j]))) AS moved FROM fold WHERE NOT done AND len(b) > 1 AND list_sum(b[-1]) < 50) AS m) AS r),
swallow AS (
  SELECT grp, 0 AS s, arg_max(b, s) AS b FROM fold GROUP BY grp
  UNION ALL
  SELECT grp, s + 1, b[1:len(b) - 2] || [list_transform(b[-2], lambda x, j: x + b[-1][j])] FROM swallow WHERE len(b) > 1 AND list_sum(b[-1]) < 10),
batches AS (SELECT grp, unnest(b) AS taken, generate_subscripts(b, 1) AS k FROM (SELECT grp, arg_max(b, s) AS b FROM swallow GROUP BY grp) AS f),
runs AS (SELECT grp, k, d, n, sum(n) OVER (PARTITION BY grp, d ORDER BY k) AS past FROM (SELECT grp, k, unnest(taken) AS n, generate_subscripts(taken, 1) AS d FROM batches) AS r),
earlier AS (SELECT grp, sum(ks) OVER (ORDER BY grp) - ks AS before FROM (SELECT grp, max(k) AS ks FROM batches GROUP BY grp) AS e),
planned AS (SELECT id, CAST(before + k AS INTEGER) AS export_batch, CASE WHEN role THEN 'ROLE-' ELSE '' END || band || '-' || {_TIER_LABEL} || '-B' || lpad(CAST(k AS VARCHAR), 2, '0') AS send_group
  FROM pool JOIN dom USING (grp, domain) JOIN runs USING (grp, d) JOIN earlier USING (grp) WHERE pos >= past - runs.n AND pos < past)
"""


@query(_PLAN_SQL + "SELECT * FROM planned")
def batch_plan(contacts):
    return batches.plan_batches(contacts).filter("export_batch is not null").select("id", "export_batch", "send_group")


@query(
    _PLAN_SQL
    + f"""SELECT export_batch, count(*) AS n, count(*) FILTER (proximity_tier = 'dealer') AS n_dealer, count(*) FILTER (proximity_tier = 'T1') AS n_t1, count(*) FILTER (proximity_tier = 'T2') AS n_t2, count(*) FILTER (proximity_tier = 'T3') AS n_t3,
      count(*) FILTER (regexp_matches(lower(split_part(email, '@', 1)), '{vocab.ROLE_INBOX}')) AS n_role, count(DISTINCT email_domain) AS domains, max(same) AS most_of_a_domain
    FROM (SELECT p.export_batch, c.email, c.email_domain, c.proximity_tier, count(*) OVER (PARTITION BY p.export_batch, c.email_domain) AS same FROM planned AS p JOIN (SELECT id, email, email_domain, proximity_tier FROM contacts) AS c USING (id)) AS x GROUP BY export_batch"""
)
def batch_plan_composition(contacts):
    return read.batch_composition(batches.plan_batches(contacts))


from . import queries_more  # noqa: E402, F401  registers further queries
