"""Hand-written cases: what the rules say, operator by operator. All names and addresses are invented."""

import json
import os
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brambler.bindings import domain
from brambler.functions import scalars as S
from brambler.operators import fusion, html, mail, people, read, release, state
from brambler.operators.preflight import contained
from brambler.plans.batches import CEILING, FLOOR, STRICT, SWALLOW, WARM, plan_batches, schedule, target
from brambler.sources import files, locators, messages, schemas, tables
from brambler.streaming.monitor import sends_by_day_stream

SF = "/root/testdata/sf0.001"


def each(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_scalars(spark):
    assert each(spark, ["New Car Sales Manager", "New Car Manager", "Head of DP", "gardener", None], S.role_normalised) == ["Sales Manager", "New Car Sales Manager", "Dealer Principal", None, None]
    assert each(spark, ["Sales Consultant", "Senior Sales Consultant", "Fleet & Sales Manager", None], S.role_plausible) == [True, False, True, False]
    assert each(spark, ["Doe, Jane", "Jane Doe", "J Doe", None], S.name_key) == ["doe jane", "doe jane", "", ""]
    assert each(spark, ["a.com.au", "a.de", "a.com", "?", "b.au; x", None], S.geo_band) == ["AU", "INTL", "COM", "COM", "AU", "COM"]
    assert each(spark, ["sales@a.test", "jo.sales-x@a.test", "salesman@a.test", None], S.is_role_inbox) == [True, True, False, False]
    assert each(spark, ["australianmotoring.com.au", "mazda.com.au", "mazdausa.com", "maz.com", ""], lambda c: mail.in_house(F.lit("Mazda Australia"), c)) == [False, True, True, True, False]
    assert each(spark, ["https://www.A.test:81/x", "a.test", None], S.site_domain) == ["A.test:81", None, None]
    assert each(spark, [" .Jo@a.test,", "x@logo.png", "-._@a.test", "none"], S.clean_address) == ["jo@a.test", None, None, None]
    assert each(spark, ["newspress: Client — New", "newspress:  — x", "newspress: c", None], S.release_company) == ["Client", None, None, None]


def test_addresses(spark):
    rows = spark.createDataFrame([(1, "O'Ann", "Lee-May", "first.last", "a.test"), (2, "Jo", None, "flast", "a.test"), (3, "Jo", None, "first", "a.test"), (4, "Jo", "Ray", "lastf", "a.test")], "id int, first_name string, last_name string, pattern string, domain string")
    assert [r.email for r in people.generate_addresses(rows).orderBy("id").collect()] == ["oann.leemay@a.test", None, "jo@a.test", "rayj@a.test"]

    def infer(*locals_):
        emails = spark.createDataFrame([(1, f"{x}@a.test", i) for i, x in enumerate(locals_)], "k int, email string, seq int")
        r = people.infer_patterns(emails, "k").first()
        return r.pattern, r.domain

    assert infer("a.b", "c.d", "e") == ("first.last", "a.test") and infer("a_b", "c_d", "e") == ("first_last", "a.test")
    assert infer("anna", "bert") == ("first", "a.test") and infer("aadams", "bbaker") == ("flast", "a.test") and infer("anna") == (None, "a.test")


def test_domain_duplicates(spark):
    def kept(*rows):
        frame = spark.createDataFrame([(i, f"jo.ray@{d}", d, n, b, False, None) for i, d, n, b in rows], "id int, email string, email_domain string, full_name string, export_batch int, suppressed boolean, suppress_reason string")
        return {r.id for r in state.dedupe_domains(frame).filter("not suppressed").collect()}

    assert kept((1, "a.com", "Jo Ray", 1), (2, "a.com.au", "Jo Ray", 9)) == {2}
    assert kept((1, "marketing.com", "Jo Ray", 1), (2, "a.com", "Jo Ray", None), (3, "b.com", "Jo Ray", 4)) == {3}
    assert kept(*[(i, f"d{i}.com", "Jo Ray", 1) for i in range(5)]) == set(range(5))
    assert kept((1, "a.com", "Jo Ray", 1), (2, "b.com", "Jo Raye", 1)) == {1, 2}


def test_ledger_is_idempotent_and_keeps_sent(spark):
    contacts, dealers = domain(spark, SF, "contacts"), domain(spark, SF, "dealerships")
    once = state.ledger_refresh(contacts, dealers)
    assert sorted(map(str, state.ledger_refresh(once, dealers).collect())) == sorted(map(str, once.collect()))
    free = contacts.filter("disposition = 'sent' and not suppressed and coalesce(cm_status, 'not_found') = 'not_found'").select("id")
    assert {r.disposition for r in once.join(free, "id").collect()} == {"sent"}


def test_suppression_only_grows(spark):
    contacts, dealers = domain(spark, SF, "contacts"), domain(spark, SF, "dealerships")
    before = {r.id for r in contacts.filter("suppressed").collect()}
    for f in (lambda c: state.ledger_refresh(c, dealers), state.dedupe_domains, state.suppress_domains, state.suppress_undeliverable, state.classify_proximity, plan_batches):
        assert before <= {r.id for r in f(contacts).filter("suppressed").collect()}


def test_upserts_with_null_keys(spark):
    old = spark.createDataFrame([("b", None, None, 1), ("b", "x", None, 2)], "brand string, suburb string, mail string, id int")
    new = spark.createDataFrame([("b", None, "n", 3), ("b", "x", "n", 4), ("b", "x", "later", 5), ("b", "y", "n", 6)], "brand string, suburb string, mail string, id int")
    got = state.upsert(old, new, ["brand", "suburb"], [F.col("id")], state.fill_null("mail")).collect()
    assert sorted((str(r.suburb), r.id, r.mail, r.inserted) for r in got) == [("None", 1, None, False), ("None", 3, "n", True), ("x", 2, "n", False), ("y", 6, "n", True)]
    assert state.insert_ignore(old, new, ["brand", "suburb"], [F.col("id")]).count() == 4


@given(st.lists(st.integers(1, 120), min_size=1, max_size=30), st.integers(1, 6))
def test_planner_keeps_all(sizes, strict):
    rows = sorted(((f"d{i}", n) for i, n in enumerate(sizes)), key=lambda r: -r[1])
    found = simulate(rows, strict=strict)
    flat = [x for b in found for x in b]
    assert sorted(flat) == sorted((d, p) for d, n in rows for p in range(n))
    if strict <= 5 and all(len(b) >= 50 for b in found):
        # folding keeps to the ceiling; what is swallowed behind it, under SWALLOW contacts, does not
        assert all(max(Counter(d for d, _ in b).values()) <= CEILING + SWALLOW - 1 for b in found)


def test_planner_examples():
    assert [len(b) for b in simulate([(f"d{i}", 100) for i in range(3)])] == [15, 15, 15, *[30] * 7, 45]
    assert [len(b) for b in simulate([(f"d{i}", 10) for i in range(60)])] == [50, 100, 150, 200, 100]
    assert [len(b) for b in simulate([("a", 100)], ramp=[2, 0])] == [2]


def test_plan_labels(spark):
    plan = plan_batches(domain(spark, SF, "contacts"))
    labels = plan.filter("send_group is not null").groupBy("send_group").agg(F.countDistinct("export_batch").alias("n")).collect()
    assert labels and all(r.n == 1 for r in labels)


def test_monitor(spark):
    def status(**n):
        return read.sends_status(spark.createDataFrame([(e,) for e, k in n.items() for _ in range(k)] or [("opened",)], "event string")).first().status

    assert status() == "no-sends" and status(sent=2000, complained=1) == "stop" and status(sent=100, bounced=3) == "stop"
    assert status(sent=100, bounced=2) == "warn" and status(sent=100, bounced=1) == "ok"


def test_files(spark, tmp_path):
    def batch(text):
        (tmp_path / "b.tsv").write_text(text)
        return [tuple(r) for r in files.batch_file(spark, f"file://{tmp_path}/b.tsv").collect()]

    assert batch("12\tPerson@Example.com\n") == [(12, "person@example.com")]
    for bad in ("1\ta@b.test\n2\tA@b.test\n", "x\ta@b.test\n", "", "1\n", "1\ta@b.test\n1\tc@b.test\n"):
        with pytest.raises(ValueError):
            batch(bad)
    archive = spark.createDataFrame([(1, "X <xa@b.test>", True, "the marker", "2024-01-01")], "mail_id int, to_header string, is_outgoing boolean, body string, sent_on string")
    (tmp_path / "b.tsv").write_text("7\ta@b.test\n")
    assert files.preflight(spark, f"file://{tmp_path}/b.tsv", archive, "THE MARKER")[0] == 1  # part of another address: fails safe
    assert files.preflight(spark, f"file://{tmp_path}/b.tsv", archive, "other")[0] == 0
    assert files.preflight(spark, f"file://{tmp_path}/none.tsv", archive, "x")[0] == 2
    (tmp_path / "l.txt").write_text(" A@b.test\nno\na@B.test\n")
    assert [r.email for r in files.address_list(spark, f"file://{tmp_path}/l.txt").collect()] == ["a@b.test"]


def test_preflight_is_any_substring_and_no_nested_loop(spark):
    headers = ['"Xa" <XA@B.test.au>, a@b.test', "a@b.test a@b.test", "@", "é@ü.test,a@@b", "none", None, "a@b.tes", "q@a@b.test@x"]
    emails = ["a@b.test", "xa@b.test", "b.test", "@", "a@", "@b", "é@ü", "a@@b", "a@b.test@", "", None, "a@b.test"]
    archive = spark.createDataFrame([(i, h, True, "the marker", "d") for i, h in enumerate(headers)] + [(90, "a@b.test", False, "the marker", "d"), (91, "a@b.test", True, "x", "d")], "mail_id int, to_header string, is_outgoing boolean, body string, sent_on string")
    people_ = spark.createDataFrame(list(enumerate(emails)), "id int, email string")
    got = sorted((r.id, r.mail_id) for r in read.preflight_matches(people_, archive, "the marker").collect())
    assert got == sorted((i, m) for i, e in enumerate(emails) for m, h in enumerate(headers) if e is not None and h is not None and e in h.lower())
    addresses = people_.filter("email like '%@%'").withColumn("email", F.concat(F.lit("u"), "id", F.lit("@b.test")))
    plan = read.preflight_matches(addresses, archive, "the marker")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join Inner, (key" in plan
    dealt = contained(people_, archive.withColumn("low", F.lower("to_header")), "mail_id", "low", 1, 2)  # an address an automaton, two headers a task
    assert sorted((r.id, r.mail_id) for r in dealt.filter("mail_id < 90").collect()) == got
    assert contained(people_.limit(0), archive, "mail_id", "to_header").count() == contained(people_, archive.limit(0), "mail_id", "to_header").count() == 0


def test_preflight_by_account(spark):
    rows = [(1, "Desk@a.test", "p@b.test", True, "x", "<p>The Marker"), (2, "other@a.test", "p@b.test", True, "the marker", None), (3, None, "p@b.test", True, "the marker", None), (4, " desk@a.test", "p@b.test", True, None, None), (5, "desk@A.test", "p@b.test", False, "the marker", None)]
    archive = spark.createDataFrame([(*r, "d") for r in rows], "mail_id int, account_email string, to_header string, is_outgoing boolean, body string, html_body string, sent_on string")
    accounts, who = spark.createDataFrame([(" DESK@a.test ",), ("desk@a.test",), (None,), ("",)], "email string"), spark.createDataFrame([(7, "p@b.test")], "id int, email string")
    assert [r.mail_id for r in read.preflight_matches(who, archive, "the marker", accounts).collect()] == [1]
    assert sorted(r.mail_id for r in read.preflight_matches(who, archive, "the marker").collect()) == [1, 2, 3]


def test_whole_tables_are_tested(spark):
    from brambler.queries import QUERIES

    contacts, all_ = domain(spark, SF, "contacts"), domain(spark, SF, "archive_whole")
    matched = {r.id for r in QUERIES["preflight_matches_whole"](spark, SF).select("id").distinct().collect()}
    own = all_.filter("is_outgoing and body like '%MARKER%'").select(F.regexp_extract(F.lower("to_header"), "<(.*)>", 1).alias("email")).distinct()
    assert {r.id for r in contacts.join(own, "email").select("id").collect()} <= matched
    assert QUERIES["published_over_derived_whole"](spark, SF).filter("confidence = 'direct'").count() == contacts.filter("email is not null").count()


PAGE = """<html><head><script type="application/ld+json">[{"@type":"Person","name":"Ann Example","jobTitle":"Sales Manager","telephone":["1","2"]},{"@type":"Org","name":"X"}]</script>
<script>var a = "</p> x@script.test"</script></head><body><p>Write to <a href="mailto:Ann@site.test?subject=x">Ann</a> or bob@site.test <b>now<p>logo@2x.png
<div class="staff-card"><h3>Cleo Example</h3><p>Service Advisor</p></div><h2>Our Cars</h2>
<a href="/our-team/">Meet the team</a><a href="https://other.test/team">Team</a><a href="/about">About us</a><a href="/staff.pdf">Our staff</a></body></html>"""


def test_page(spark):
    parsed = html.parse_pages(spark.createDataFrame([(1, "https://site.test/", PAGE), (2, None, None)], "page_id int, url string, html string"))
    assert {r.email for r in html.emails_of_pages(parsed).collect()} == {"ann@site.test", "bob@site.test"}
    ld = html.jsonld_people(parsed).collect()
    assert [(r.name, r.role, r.phone) for r in ld] == [("Ann Example", "Sales Manager", "1")]
    cards = html.card_people(parsed)
    assert [(r.name, r.role) for r in cards.collect()] == [("Cleo Example", "Service Advisor")]
    assert {(r.name, r.found_in) for r in html.fuse_people(html.jsonld_people(parsed), cards).collect()} == {("Ann Example", "jsonld"), ("Cleo Example", "page")}
    assert {(r.href, r.score, r["rank"]) for r in html.link_scores(parsed).collect()} == {("https://site.test/our-team/", 23, 1), ("https://site.test/about", 2, 2)}
    assert each(spark, ["info@a.test", "jo@mail.google.com", "jo@a.test", "salesford@a.test"], html.email_kind) == ["generic", None, "person", "generic"]
    assert each(spark, ["Ann Example", "Sales Manager", "ann example", "Ann", "Meet The Team"], html.name_plausible) == [True, False, False, False, False]
    assert each(spark, ["Jane Head", "Toyota Corolla", "Darwin Jeep", "Jane Doe (x)", "JANE EXAMPLE", "JO DOE", "Élise Ray", "Big Utes", "Ioniq 5 N", "A B C D E F", "Role: Jane", None], html.name_plausible) == [True, False, False, False, False, True, True, False, False, False, False, None]
    assert [r.x for r in spark.createDataFrame([("a b  c",), ("a",), ("",), (None,)], "v string").select(F.array(*S.split_at_first(F.col("v"))).alias("x")).collect()] == [["a", "b  c"], ["a", None], [None, None], [None, None]]


def test_mail(spark):
    raw = [
        "\nSubject: Undeliverable: hi\nFrom: x@y.test\n\nX-Failed-Recipients: Gone@a.test",
        "Subject: =?utf-8?q?Out_of_office?=\nAuto-Submitted: auto-replied\nFrom: Jo <Jo@b.test>\nDate: Tue, 02 Jan 2024 01:00:00 +0000\n\nAsk Ann Example, Service Manager: ann.example@c.test or info@c.test",
        "Subject: out of office\nFrom: jo@b.test\n\nno header",
    ]
    parsed = mail.parse_messages(spark.createDataFrame(list(enumerate(raw)), "msg_id int, raw string"))
    assert [(r.kind, r.email, str(r.evdate)) for r in mail.classify(parsed).orderBy("msg_id").collect()] == [("bounce", "gone@a.test", "None"), ("ooo", "jo@b.test", "2024-01-02"), (None, None, "None")]
    found = {r.email: r for r in mail.harvest_replies(parsed.filter("msg_id = 1")).collect()}
    assert (found["ann.example@c.test"].full_name, found["ann.example@c.test"].role, found["ann.example@c.test"].reason) == ("Ann Example", "Service Manager", None)
    assert found["info@c.test"].reason == "role"


def test_people_in_text_where_there_are_no_others(spark):
    def names(page):
        parsed = html.parse_pages(spark.createDataFrame([(1, "https://site.test/", page)], "page_id int, url string, html string"))
        return [(r.name, r.role) for r in html.card_people(parsed).orderBy("seq").collect()]

    line = "<p>Ann Example - Sales Manager<br></p>\n<p>Bo Example | Service Advisor</p>\n<p>ann Example - x</p>\n<p>Ann Example - Director</p>"
    assert names(f"<nav>Cy Example - Manager</nav>{line}") == [("Ann Example", "Sales Manager"), ("Bo Example", "Service Advisor")]
    assert names(f"<h3>Cleo Example</h3><p>Service Advisor</p>{line}") == [("Cleo Example", "Service Advisor")]
    assert names(f'<div class="card"><h3>Our Team</h3></div><h3>Cleo Example</h3><p>Service Advisor</p>{line}') == [("Cleo Example", "Service Advisor")]


def test_context_of_replies(spark):
    def found(body, reply_to=None):
        parsed = spark.createDataFrame([(1, "s@s.test", reply_to, body)], "msg_id int, sender string, reply_to string, body string")
        return {r.email: (r.full_name, r.role) for r in mail.harvest_replies(parsed).collect()}

    assert found("hello\njd@a.test is Jane Doe\nBo Ray") == {"jd@a.test": ("Jane Doe", None)}
    assert found("hello Jane Doe", "jd@a.test") == {"jd@a.test": (None, None)}
    assert found("jd@a.test " + "x " * 60 + "Service Manager") == {"jd@a.test": (None, None)}


def test_all_appointments(spark):
    def people_(title, body):
        rows = mail.appointments(spark.createDataFrame([(1, title, body)], "release_id int, title string, body string"))
        return {r.name: r.role for r in rows.collect()}

    assert people_("News", "Acme has appointed Jane Doe as General Manager. Bo Ray has been appointed to the Head of Design role from May.") == {"Jane Doe": "General Manager", "Bo Ray": "Head of Design role"}
    assert people_("New chief", "This is about the appointment of Jane Doe, who succeeds Bo Ray.") == {"Jane Doe": None}
    assert people_("Acme welcomes Jane Doe", "She starts on Monday.") == {"Jane Doe": None}
    assert people_(None, "Jane Doe joins Acme as Director of Sales at Acme Motors. Jane Doe has been named a Fellow.") == {"Jane Doe": "Director of Sales"}
    assert people_("x", "Acme welcomes Sales Team as guests; welcomes " + "Jane Doe to " + "w " * 9) == {"Jane Doe": None}
    assert people_("Bo Ray", "nobody has been hired") == people_("Acme welcomes Jane Doe", None) == {}


def test_appointees_of_whole_texts(spark):
    """The guesses of a release whose text tells of the appointment far behind its start."""
    far = "<p>" + "Nothing new in the yard. " * 200 + "</p><p>Acme has appointed Jane Doe as Sales Manager. Ann Example ann.example@acme.test</p>"
    table = spark.createDataFrame([(1, "Acme Cars", "Changes", far, "2024-01-01", 1)], "release_id int, client_name string, title string, content_html string, release_date string, list_pos int")
    assert [(r.email, r.name, r.role_raw) for r in release.appointee_addresses(table).collect()] == [("jane.doe@acme.test", "Jane Doe", "Sales Manager")]


def test_appointments_of_whole_texts(spark):
    """Gate and sentences, wherever they stand: behind 1,500 and 1,800 characters and across these places."""
    fill = lambda n: ("nobody new here " * (n // 16 + 1))[:n]
    texts = [fill(2000) + " Acme has appointed Jane Doe as Sales Manager.", fill(1470) + " Acme Motors has been pleased; Jane Doe has been appointed as Sales Manager.", "Jane Doe has been appointed. " + fill(3000) + " Jane Doe has been appointed as Sales Manager. Bo Ray joins Acme as Buyer."]
    texts += [fill(1480) + " has appointed Jane Doe as " + "w " * n + "Manager." for n in (5, 9)] + [fill(900_000) + " Acme welcomes Jane Doe as Buyer."]
    rows = spark.createDataFrame(list(enumerate(texts)), "release_id int, body string").withColumn("title", F.lit("News"))
    found = sorted((r.release_id, r.name, r.role) for r in mail.appointments(rows).collect())
    jane = "Jane Doe"
    assert found == [(0, jane, "Sales Manager"), (1, jane, "Sales Manager"), (2, "Bo Ray", "Buyer"), (2, jane, "Sales Manager"), (3, jane, "w w w w w Manager"), (4, jane, None), (5, jane, "Buyer")]


def test_names_of_appointments_begin_where_they_did(spark):
    """A name begins with its word's first capital, or with the first behind a role that was cut off in the word."""
    cut = "Al Oak has been named " + "w" * 54 + "xJaneMc Doe has been named a Fellow."
    rows = spark.createDataFrame([(1, "eJane O'Doe has been named Buyer. " + cut), (2, "A-'b" * 200_000 + " has been named; Bo Ray has been named Buyer")], "release_id int, body string").withColumn("title", F.lit("x"))
    assert sorted((r.release_id, r.name, r.role) for r in mail.appointments(rows).collect()) == [(1, "Al Oak", "w" * 54 + "xJane"), (1, "Jane O'Doe", "Buyer"), (1, "Mc Doe", "a Fellow"), (2, "Bo Ray", "Buyer")]


def test_locators(spark):
    def rows(brand, *payloads):
        raw = spark.createDataFrame([(brand, i, json.dumps(p)) for i, p in enumerate(payloads)], "brand_slug string, seq long, payload_json string")
        return locators.project(raw, brand).orderBy("seq").collect()

    def one(brand, payload):
        return [tuple(r[2:]) for r in rows(brand, payload)]

    assert len(locators.BRANDS) == 20
    full = (" A ", "1 B St", "Town", "VIC", "3000", "03 1", "https://a.test", "Jo@A.test")
    want = ("A", *full[1:7], "jo@a.test")
    silent = (*want[:7], None)
    name, address, suburb, state_, postcode, phone, site, mail_ = full
    toyota = {"dealerCode": "1", "name": name, "address": address, "city": suburb, "state": state_, "postCode": postcode, "telephone": phone, "webSite": site, "email": mail_}
    assert one("toyota", {"results": [toyota, {"dealerCode": "2", "name": " "}, {"name": "without a code"}]}) == [want]
    assert [r.name for r in rows("toyota", {"results": [toyota]}, {"results": [toyota | {"name": "B"}]})] == ["A"]
    assert one("mitsubishi", {"data": {"stockists": {"locations": [{"identifier": "x", "name": name, "website": site, "address": {"street": address, "city": suburb, "region": state_, "postcode": postcode, "phone": phone}}]}}}) == [silent]
    hyundai = {"tradingName": name, "streetName": address, "suburb": suburb, "state": state_, "postcode": postcode, "phone": phone, "webAddress": "", "url": site, "email": mail_}
    assert one("hyundai", [hyundai, {"name": "no"}]) == [want] and one("hyundai", [hyundai | {"webAddress": " "}])[0][6] is None
    kia = {"dealerNm": name, "addr": suburb, "area": state_, "addrSC": "9 Long Road 3000", "phone": phone, "homepage": site, "email": "Jo@A.test , x@b.test"}
    assert one("kia", {"dataInfo": [kia]}) == [("A", "9 Long Road 3000", *want[2:])]
    assert one("kia", {"dataInfo": [kia | {"addrSC": ""}]})[0][1:5] == ("Town", "Town", "VIC", None)
    for brand in ("ford", "audi", "volvo"):
        cards = [{"name": f" {brand.title()} X", "text": "2 High St, QLD 4000 (07) 5555 0000"}, {"name": f"{brand.title()} X", "text": "later"}, {"name": "Other", "text": "VIC"}]
        assert one(brand, cards) == [(f"{brand.title()} X", None, None, "QLD", "4000", "(07) 5555 0000", None, None)]
    assert one("mazda", [{"name": name, "address": address, "suburb": suburb, "state": state_, "postCode": postcode, "website": site, "departments": [{"phone": "", "email": None}, {"phone": phone, "email": mail_}, {"phone": "9"}]}]) == [want]
    nissan = {"name": name, "address": {"addressLine1": address, "city": suburb, "stateCode": state_, "postalCode": postcode}, "contact": {"phones": [{"value": phone}, {"value": "9"}], "websites": [{"url": site}]}, "departments": [{"contact": {"email": "none"}}, {"contact": {"email": mail_}}]}
    assert one("nissan", {"dealers": [nissan]}) == [want]
    assert one("nissan", {"dealers": [{"name": name}]}) == [("A", *[None] * 7)]
    sales = {"IsActive": False, "Address": {"Suburb": "No"}, "Contact": {"Phone": "no", "Email1": "no@a.test"}}
    service = {"IsActive": True, "Address": {"Suburb": "", "State": "No"}, "Contact": {"Website": {"Url": site}, "Email1": "none", "Email2": mail_}}
    parts = {"IsActive": True, "Address": {"Suburb": suburb, "State": "Victoria", "Street": address, "PostCode": 3000}, "Contact": {"Website": "https://later.test", "Phone": phone}}
    assert one("isuzu", {"Dealers": [{"Name": name, "IsActive": True, "Sales": sales, "Service": service, "Parts": parts}, {"Name": "J", "IsActive": False}]}) == [want]
    location = {"isPrimary": True, "AddressLine1": address, "AddressSuburb": suburb, "AddressPostcode": postcode, "Phone": phone}
    honda = {"Name": name, "State": state_, "Website": "/h", "Locations": [{"isPrimary": False, "AddressSuburb": "Other"}, location]}
    assert one("honda", [honda]) == [(*want[:6], locators.HONDA_SITE + "/h", None)]
    assert one("honda", [honda | {"Website": site, "Locations": [location | {"isPrimary": None}]}]) == [silent] and one("honda", [{"Name": name}]) == [("A", *[None] * 7)]
    detail = {"suburb": suburb, "url": site, "address": address, "postCode": postcode, "phone": phone, "email": mail_}
    assert one("subaru", [{"name": name, "state": state_, "isActive": True, "dealerDetails": [detail, {"suburb": "later"}]}, {"name": "off", "isActive": False}]) == [want]
    assert one("bmw", {"data": {"pois": [{"name": name, "street": address, "city": suburb, "state": "Victoria", "postalCode": postcode, "attributes": {"phone": phone, "homepage": site, "mail": mail_}}]}}) == [want]
    mercedes = {"legalName": name, "url": site, "address": {"addressLine1": address, "city": suburb, "region": state_, "postalCode": postcode}, "contact": {"phone": phone}}
    assert one("mercedes", {"dealers": [mercedes, mercedes | {"contact": "plain"}]}) == [silent, (*want[:5], None, want[6], None)]
    assert one("ldv", {"result": {"data": {"allCmsBrandDealer": {"nodes": [{"name": name, "address": address, "suburb": suburb, "state": state_, "postcode": postcode, "phone": phone, "contactUrl": None, "url": site, "email": mail_}]}}}}) == [want]
    dealer = {"dealerCode": "7", "dealerName": name, "dealerState": state_, "SalesSuberbCode": suburb, "SalesStreetCode": "", "dealerAddress": address, "SalesPostCode": postcode, "SalesPhoneCode": None, "phone": phone, "dealerWebsite": site, "SalesEmailCode": " ", "FinanceEmail": mail_}
    assert one("volkswagen", {"dealers": [{"dealer": dealer}]}) == [want] == one("volkswagen", [{"dealers": [{"dealer": dealer}]}, {"errorCode": 1}])
    assert one("jeep", {"dealers": [{"id": 5, "name": name, "phone": phone, "web_site": site, "address": {"line1": address, "city": suburb, "state": state_, "postal_code": postcode}}]}) == [silent]
    mg = {"Dealer_Name": name, "Showroom_Address": "1 B St, Town VIC 3000", "Phone_Number": phone, "MG_Website": site}
    assert one("mg", {"VIC": {"code": 3000, "result": {"Dealer_List": [mg]}}, "NSW": {"code": 2955, "result": {"Dealer_List": [mg]}}}) == [("A", "1 B St, Town VIC 3000", *silent[2:])]
    byd = lambda raw: one("byd", [{"name": "BYD X", "website": site, "rawText": raw}])
    assert byd("BYD XExperience Centre Closest 54 aberdeen st,Albany WA 6330 Visit") == [("BYD X", "54 aberdeen st", "Albany", "WA", "6330", None, site, None)]
    assert byd("BYD XMegastore Closest Shop 4,Albany WA 6330") == [("BYD X", "Shop 4", "Albany", "WA", "6330", None, site, None)]
    assert byd("nothing") == [("BYD X", None, None, None, None, None, site, None)]
    gwm = lambda whole: one("gwm", [{"name": name, "address": whole, "phone": phone, "email": mail_}, {"name": name}])[0][1:5]
    assert gwm("1 B St, Town, VIC, 3000") == gwm("1 B St, Town, VIC 3000") == ("1 B St", "Town", "VIC", "3000") and gwm("1 B St, Town") == ("1 B St, Town", None, None, None)
    assert rows("nobody", {}) == []
    for brand in locators.BRANDS:
        assert rows(brand, {}) == []


def test_stream_equals_batch(spark, tmp_path):
    events = domain(spark, SF, "send_events")
    events.write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events")
    q = sends_by_day_stream(stream).writeStream.outputMode("complete").format("memory").queryName("days").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("days").collect())) == sorted(map(str, read.sends_by_day(events).collect()))


def test_releases(spark):
    body = "<table><tr><th>Media contacts</th><th></th></tr><tr><td>Ann Example</td><td>Bo Example</td></tr><tr><td>Ann@a.test</td><td>bo@a.test</td></tr></table><p>c@a.test</p><table><tr><td>x@other.test</td></tr></table>"
    rows = spark.createDataFrame([(1, body), (2, None)], "release_id int, content_html string")
    tables = release.contact_tables(rows)
    assert [(r.name, r.email) for r in tables.orderBy("seq").collect()] == [("Ann Example", "ann@a.test"), ("Bo Example", "bo@a.test"), (None, "x@other.test")]
    assert {(r.email, r.name) for r in release.release_contacts(rows, tables).collect()} == {("ann@a.test", "Ann Example"), ("bo@a.test", "Bo Example"), ("c@a.test", None), ("x@other.test", None)}
    assert {(r.email, r.full_name) for r in release.release_people(rows).collect()} == {("ann@a.test", "Ann Example"), ("bo@a.test", "Bo Example"), ("c@a.test", "Example Ann"), ("x@other.test", "Example Ann")}  # the last name before
    cell = lambda c, t: f"<td><a href='mailto:{t}'>{c}</a></td>" if t else f"<td>{c or ''}</td>"
    table = lambda *rows: "<table>" + "".join("<tr>" + "".join(cell(*c) for c in row) + "</tr>" for row in rows) + "</table>"
    read_table = lambda html: [(r.name, r.email) for r in release.contact_tables(spark.createDataFrame([(1, html)], "release_id int, content_html string")).orderBy("seq").collect()]
    assert read_table(table([("Press office", None)], [("Al Ray", None), ("Sales Team", None)], [("Head", None), ("", None)], [("write", "al@a.test"), ("b@a.test", None)], [("c@a.test", None)])) == [("Al Ray", "al@a.test"), (None, "b@a.test")]
    assert read_table(table([("no", None)])) == [] and read_table(table([("x@a.test", None)], [("Media contact", None)])) == []
    named = spark.createDataFrame([(1, "Jane Doe named", "Acme today said Jane Doe has been appointed as General Manager of Acme."), (2, "x", "nothing")], "release_id int, title string, body string")
    assert [(r.name, r.role) for r in mail.appointments(named).collect()] == [("Jane Doe", "General Manager")]
    formats = spark.createDataFrame([(1, "a.test", "first.last"), (1, "b.test", "flast"), (1, "b.test", "first")], "release_id int, domain string, pattern string")
    assert [(r.email, r.confidence) for r in mail.extrapolate(spark.createDataFrame([(1, "Jane Doe")], "release_id int, name string"), formats).collect()] == [("jane.doe@a.test", "inferred")]
    assert each(spark, ["acme.test", "acmecars.test", "havas.test", "other.test"], lambda c: mail.in_house(F.lit("Acme Motors"), c)) == [True, True, False, False]
    assert each(spark, ["australianmotoring.com.au", "mazda.com.au", "mazdausa.com", "maz.com", ""], lambda c: mail.in_house(F.lit("Mazda Australia"), c)) == [False, True, True, True, False]
    assert each(spark, ["2024-01-02", "03/02/2024", "soon"], lambda c: mail.release_date([F.lit(None).cast("string"), c]).cast("string")) == ["2024-01-02", "2024-02-03", None]


def test_edition():
    html = "[if:a]x[else]y[endif]<body><div id=cut>1<div>2</div></div><p>"
    assert release.edition(html, "HI", "<body>", ["id=cut"]) == ("y<body>HI<p>", True)
    for bad in ("[if:a]", "<body><body>", "<body><div id=cut>"):
        with pytest.raises(ValueError):
            release.edition(bad, "HI", "<body>", ["id=cut"] if "cut" in bad else [])


def test_cockpit(spark):
    parts = release.cockpit(domain(spark, SF, "contacts"), domain(spark, SF, "dealerships"), domain(spark, SF, "send_events"))
    assert parts["summary"].count() == 1 and 0 < parts["sends"].count() <= 30 and 0 < parts["contacts"].count() <= 600


def simulate(lengths: list[tuple[str, int]], ramp: list[int] | None = None, strict: int = STRICT) -> list[list[tuple[str, int]]]:
    """The plan contact by contact: batches of (domain, position in its queue) for domains in their order."""
    taken, batches = {d: 0 for d, _ in lengths}, []
    while True:
        goal, cap = target(len(batches), ramp), strict if len(batches) < WARM else 2 * strict
        batch, used = [], dict.fromkeys(taken, 0)
        moved = True
        while moved and len(batch) < goal:
            moved = False
            for d, n in lengths:
                if len(batch) >= goal:
                    break
                if used[d] < cap and taken[d] < n:
                    batch.append((d, taken[d]))
                    taken[d] += 1
                    used[d] += 1
                    moved = True
        if not batch:
            break
        batches.append(batch)
    while len(batches) > 1 and len(batches[-1]) < FLOOR:  # fold a short tail, as far as domains allow
        last, count, rest = batches.pop(), {}, []
        for d, _ in batches[-1]:
            count[d] = count.get(d, 0) + 1
        for d, p in last:
            if count.get(d, 0) < CEILING:
                batches[-1].append((d, p))
                count[d] = count.get(d, 0) + 1
            else:
                rest.append((d, p))
        if rest:
            batches.append(rest)
            break
    while len(batches) > 1 and len(batches[-1]) < SWALLOW:
        last = batches.pop()
        batches[-1] += last
    return batches


@given(st.lists(st.integers(0, 400), max_size=12), st.sampled_from([None, [3], [20, 7], [60]]), st.integers(1, 6))
def test_schedule_is_the_plan_by_contact(sizes, ramp, strict):
    want = simulate([(f"d{i}", n) for i, n in enumerate(sizes)], ramp, strict)
    got = schedule(sizes, ramp, strict)
    assert [{f"d{d}": n for d, n in b.items()} for b in got] == [dict(Counter(d for d, _ in b)) for b in want]
    place: Counter = Counter()
    for batch in want:  # a domain's contacts go in order of its queue
        for d, positions in {d: sorted(p for x, p in batch if x == d) for d, _ in batch}.items():
            assert positions == list(range(place[d], place[d] + len(positions)))
            place[d] += len(positions)


def test_tree():
    from brambler.operators.tree import tree

    root = tree("<p>a<p>b<div>c<br>d</div><ul><li>1<ul><li>1.1</ul><li>2</ul><table><tr><td>x<td><table><tr><td>in</table>y<tr><td>z</p></table>e</b>&amp;<script>no</p></script>")
    shape = [(x.tag, x.parent.tag) for x in root.walk()]
    assert shape == [("p", ""), ("p", ""), ("div", ""), ("br", "div"), ("ul", ""), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul"), ("table", ""), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("table", "td"), ("tr", "table"), ("td", "tr"), ("tr", "table"), ("td", "tr"), ("script", "")]
    assert root.text() == "abcd11.12xinyze&" and root.text("|", strip=True) == "a|b|c|d|1|1.1|2|x|in|y|z|e|&"
    assert [y.text() for x in root.walk() if x.tag == "p" for y in x.following({"p", "div"}, 2)] == ["b", "cd", "cd"]
    deep = tree("<div>" * 20_000 + "x")
    assert deep.text() == "x" and sum(1 for _ in deep.walk()) == 20_000 and tree(None).text() == ""


def test_people_of_cards(spark):
    def names(page):
        parsed = html.parse_pages(spark.createDataFrame([(1, "https://site.test/", page)], "page_id int, url string, html string"), parts=("content", "headings"))
        return [(r.name, r.role) for r in html.card_people(parsed).orderBy("seq").collect()]

    # text behind an element is its parent's; a role is looked for beside the name, not in the next card
    page = '<div class="team-member"><h3>Jane Doe</h3>Sales Manager</div><div class="team-member"><h3>Bob Ray</h3><p>Parts Manager</p></div><table><tr><td>in</td></tr></table>'
    assert names(page) == [("Jane Doe", None), ("Bob Ray", "Parts Manager")]
    assert names('<li class="x PROFILE-box"><b>Jane Doe</b><span>since 2001</span><div>Head</div><p>Sales <i>Manager</i></p><p>Director</p></li>') == [("Jane Doe", None)]
    assert names('<section class="crew"><div><strong>Jane Doe</strong><em>x</em><p>a</p><p>b</p><p>Director</p><p>Manager</p></div><h2>jane doe</h2><h2>Jane DOE</h2><h1>Al Head</h1></section>') == [("Jane Doe", "Director")]
    assert names("<h2>Jane <br>Doe</h2><p>Manager</p><h3>Al Ray</h3><div><p>Manager</p></div><h4>Bo Lee</h4><ul><li>Manager</li></ul>") == [("Al Ray", "Manager")]
    assert names('<nav class="team"><h3>No One</h3><p>Manager</p></nav><div class="card"><footer><h3>No Two</h3></footer></div><h2>Al Ray</h2><footer>x</footer><p>Technician, senior</p>') == [("Al Ray", "Technician, senior")]
    assert each(spark, ["md", "dp, director", "x director director", "manager" * 9, "Parts - Interpreter", "a/b & director", "exdirector / director", " Analyst "], S.role_plausible) == [False, True, False, False, True, True, False, True]
    assert each(spark, ['<a href="mailto:">', "<A HREF='mailto:'>", '<a href="mailto:x@a.test">', None], html.needs_render) == [True, True, False, False]


def test_tables_in_cells(spark):
    inner = "<table><tr><td>Bo Example</td></tr><tr><td>bo@a.test</td></tr></table>"
    body = f"<table><tr><th>Contacts</th></tr><tr><td>Ann Example</td><td>{inner}</td></tr><tr><td><a href='MAILTO:Ann.X@a.test'>mail</a></td><td>cy@a.test</td></tr></table>"
    found = release.contact_tables(spark.createDataFrame([(1, body), (2, None), (3, "<table><tr><td>Al Ray</td></tr>")], "release_id int, content_html string")).orderBy("seq").collect()
    # the outer table's first row with an address is the one that holds the inner table; its cells come before the inner table's own
    assert [(r.name, r.email) for r in found] == [(None, "bo@a.test"), (None, "bo@a.test"), ("Bo Example", "bo@a.test")]
    head = f"<table><tr><th>Contacts <table><tr><td>logo</td></tr></table></th></tr><tr><td>Ann Example</td></tr><tr><td>ann@a.test</td></tr></table>"
    found = release.contact_tables(spark.createDataFrame([(1, head)], "release_id int, content_html string")).collect()
    assert [(r.name, r.email) for r in found] == [("Ann Example", "ann@a.test")]
    tail = f"<table><tr><td>{inner}</td></tr><tr><td>Ann Example</td></tr><tr><td>ann@a.test</td></tr></table>"
    assert [len(t) for t in release.read_releases(spark.createDataFrame([(1, tail)], "release_id int, content_html string")).first().tables] == [5, 2]


def test_appointees(spark):
    rows = [
        (1, "Acme Cars", " Jane Doe joins ", "<p>Acme said Jane Doe has been appointed as Head of Sales at Acme. Ann Example ann.example@acme.test, Bo Ray bo.ray@acme.test</p>", "2024-01-01", 1),
        (2, "Acme Cars", "new md", "<p>welcomed Jane Doe as Managing Director of Acme. Cy Fox cfox@acme.test Di Ash di.ash@acme.test</p>", "2024-02-01", 2),
        (3, "Acme Cars", "named", "<p>appointed Jane Doe to Sales Manager. Ann Example ann.example@acme.test</p>", "2024-03-01", 3),
        (4, "Acme Cars", "named", "<p>appointed Al Oak to Parts Manager. Ann Example ann.example@msl.test</p>", "2024-03-01", 4),
        (5, "Bolt", "named", "<p>appointed Bo Ray to Parts Manager. Ed Elm eelm@boltcars.test, Bo Ray bray@boltcars.test</p>", None, 5),
        (6, None, "named", None, None, 6),
    ]
    table = spark.createDataFrame(rows, "release_id int, client_name string, title string, content_html string, release_date string, list_pos int")
    found = release.appointee_addresses(table).collect()
    assert [(r.email, r.name, r.role_raw, r.role, r.pattern, r.release_date) for r in found] == [("jane.doe@acme.test", "Jane Doe", "Head of Sales", None, "first.last", "2024-03-01")]
    assert each(spark, ["havasmedia.test", "acme.msl.test", "acme.bosch.test"], lambda c: mail.in_house(F.lit("Acme"), c)) == [False, False, True]


def test_messages(spark, tmp_path):
    for k, text in enumerate(["Subject: one\n\nFrom here on", "  \n", "Subject: two\n\nb\xff"]):
        (tmp_path / "cur" / f"{k}.eml").parent.mkdir(exist_ok=True)
        (tmp_path / "cur" / f"{k}.eml").write_bytes(text.encode("latin-1"))
        os.utime(tmp_path / "cur" / f"{k}.eml", (1_700_000_000 + 10 * (k == 0), 1_700_000_000 + 10 * (k == 0)))
    where = f"file://{tmp_path}/cur"
    assert {r.msg_id.rsplit("/", 1)[1]: r.raw for r in messages.message_files(spark, where).collect()} == {"0.eml": "Subject: one\n\nFrom here on", "2.eml": "Subject: two\n\nb\ufffd"}
    assert [r.msg_id.rsplit("/", 1)[1] for r in messages.message_files(spark, where, 1).collect()] == ["0.eml"]
    assert messages.message_files(spark, where, 0).count() == 0
    with pytest.raises(ValueError):
        messages.message_files(spark, where, -1)
    (tmp_path / "box").mkdir()
    (tmp_path / "box" / "a.mbox").write_text("From x@a.test Mon\nSubject: out of office\nAuto-Submitted: auto-replied\nFrom: jo@b.test\n\nhi\n\nFrom y@a.test Tue\nSubject: Undeliverable\n\nX-Failed-Recipients: gone@a.test\n\nFrom \n\n")
    box = messages.messages_in(spark, f"file://{tmp_path}/box")
    assert sorted((r.kind, r.email) for r in mail.classify(mail.parse_messages(box)).collect()) == [("bounce", "gone@a.test"), ("ooo", "jo@b.test")]
    (tmp_path / "box" / "a.mbox").write_text("\n==SEP==\none\n==SEP==\n \n==SEP==\ntwo\nlines\n==SEP==\none")
    parts = messages.messages_in(spark, f"file://{tmp_path}/box", "\n==SEP==\n").collect()
    assert sorted(r.raw for r in parts) == ["one", "one", "two\nlines"] and len({r.msg_id for r in parts}) == 2


def test_stored_tables(spark, tmp_path):
    def files_of(path):
        return {str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in path.rglob("*.parquet")}

    path, schema = tmp_path / "store", "k string, a int, b int"
    first = spark.createDataFrame([(f"k{i}", i, None) for i in range(60)] + [(None, 1, 1)], schema)
    tables.create(first, f"file://{path}", ["k"], 8)
    before = files_of(path)
    changes = spark.createDataFrame([("k3", 1, 2), ("k3", 0, 9), ("new", 5, 5), (None, 1, 1)], schema)
    n = tables.apply(spark, f"file://{path}", changes, ["k"], 8, [F.col("a")], state.fill_null("b"))
    after = files_of(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert 0 < n <= 3 and len(before) == 8 and len(same) == 8 - n  # untouched buckets keep their files
    rows = {r.k: (r.a, r.b) for r in tables.load(spark, f"file://{path}").collect()}
    assert rows["k3"] == (3, 9) and rows["new"] == (5, 5) and rows["k4"] == (4, None) and tables.load(spark, f"file://{path}").filter("k is null").count() == 2
    assert tables.load(spark, f"file://{path}").columns == ["k", "a", "b"] and tables.load(spark, f"file://{path}").count() == 63
    assert tables.apply(spark, f"file://{path}", changes.limit(0), ["k"], 8, [F.col("a")], state.fill_null("b")) == 0 and files_of(path) == after


def test_stored_versions(spark, tmp_path):
    at = lambda k: f"file://{tmp_path}/{k}"
    spark.createDataFrame([(1, "A")], "id long, full_name string").write.parquet(at(1))
    spark.createDataFrame([("2", "B", True)], "id string, full_name string, suppressed boolean").write.parquet(at(2))
    spark.createDataFrame([("x", "C")], "id string, full_name string").write.parquet(at(3))
    spark.createDataFrame([(1, 2)], "id long, unknown int").write.parquet(at(4))
    rows = schemas.stored(spark, [at(1), at(2)], "contacts")
    assert rows.columns == [*schemas.schema("contacts").names, "version"] and rows.schema["id"].dataType.simpleString() == "bigint"
    assert sorted((r.id, r.full_name, r.suppressed, r.sent_at, r.version) for r in rows.collect()) == [(1, "A", None, None, 1), (2, "B", True, None, 2)]
    with pytest.raises(Exception, match="id: no bigint: x"):
        schemas.stored(spark, [at(3)], "contacts").collect()
    assert len(schemas.schema("contacts").names) == 36 and len(schemas.schema("dealerships").names) == 16 and {len(schemas.schema(t).names) for t in ("send_events", "ooo_domain_formats", "active_subscribers")} == {9, 7, 5}
    with pytest.raises(KeyError):
        schemas.schema("send_events", 4)
    for paths, version in (([at(4)], None), ([at(2)], 1)):
        with pytest.raises(ValueError):
            schemas.stored(spark, paths, "contacts", version)


def test_release_list(spark):
    rows = [("a", 1, 9, [5, 3, None, 5]), ("a", 2, 9, [3, 7]), ("a", 3, 9, []), ("a", 4, 9, [8]), ("b", 1, 1, [1]), ("b", 2, 1, [2]), ("c", 1, None, [4]), ("c", 3, None, [6]), ("d", 1, None, None), ("d", 2, None, [1])]
    pages = spark.createDataFrame(rows, "list_name string, page int, last_page int, ids array<long>")
    got = lambda n=None: sorted((r.list_name, r.list_pos, r.release_id) for r in release.release_list(pages, n).collect())
    assert got() == [("a", 1, 5), ("a", 2, 3), ("a", 3, 7), ("b", 1, 1), ("c", 1, 4)]
    assert got(1) == [("a", 1, 5), ("a", 2, 3), ("b", 1, 1), ("c", 1, 4)] and release.release_list(pages.limit(0)).count() == 0


def test_small_rests(spark, tmp_path):
    html_mail = "From: Jo <Jo@b.test>\nReply-To: A <a.b@c.test>, d.e@c.test\nContent-Type: text/html\n\n<style>x</style><p>Ask A&amp;B &lt;ann.example@c.test&gt;, Parts&nbsp;Manager<script>no</script> jo@b.test.au"
    parsed = mail.parse_messages(spark.createDataFrame([(1, html_mail)], "msg_id int, raw string"))
    row = parsed.first()
    assert (row.body, row.sender_address, row.reply_to) == ("Ask A&B <ann.example@c.test>, Parts\xa0Manager\n jo@b.test.au", "jo@b.test", "a.b@c.test d.e@c.test")
    found = {r.email: r for r in mail.harvest_replies(parsed).collect()}
    assert set(found) == {"ann.example@c.test", "jo@b.test.au", "a.b@c.test", "d.e@c.test"}  # the sender's address within another is no sender
    assert each(spark, ['{"date":"2024-02-03T10:00:00Z","published_at":""}', '{"live_date":"04/05/2024","createdAt":"soon"}', "{}", None], lambda c: mail.release_date_of(c).cast("string")) == ["2024-02-03", "2024-05-04", None, None]
    lookups = spark.createDataFrame([("a", "h", None), ("a", None, "NXDOMAIN"), ("b", None, "NXDOMAIN"), ("c", None, "NoNameservers"), ("d", None, None), ("e", None, "Timeout")], "domain string, host string, error string")
    assert {r.domain: r.lookup for r in people.lookup_status(lookups).collect()} == {"a": "", "b": "nxdomain", "c": "no_mx", "d": "no_mx", "e": "dns_error:Timeout"}
    files_ = spark.createDataFrame([("a", "[if:x]1[else]2[endif]<body>"), ("b", "none"), ("c", None)], "name string, html string")
    assert [(r.name, r.html, r.fits, r.error is None) for r in release.editions(files_, "HI", "<body>", []).orderBy("name").collect()] == [("a", "2<body>HI", True, True), ("b", None, None, False), ("c", None, None, False)]
    contacts = spark.createDataFrame([(1, "b", None, "Z"), (2, "a", "D", "Y"), (3, "a", "D", "X"), (4, None, None, "Q")], "id int, brand_slug string, dealership string, full_name string")
    files.export_csv(contacts, f"file://{tmp_path}/out")
    assert [line.split(",")[0] for f in sorted((tmp_path / "out").glob("*.csv")) for line in f.read_text().splitlines()[1:]] == ["4", "3", "2", "1"]
    assert [r.x for r in spark.createDataFrame([("Jane van Doe",), ("Jane",), (" ",)], "v string").select(F.array(*S.split_first_rest(F.col("v"))).alias("x")).collect()] == [["Jane", "van Doe"], ["Jane", None], ["", None]]
    assert str(spark.range(1).select(release.months_before(F.lit("2024-03-01").cast("date"), 2).alias("d")).first().d) == "2024-01-01"
    flags = spark.createDataFrame([(1, True, "left_employer", "ruled_out", "x", "y"), (2, False, None, "in_play", None, None), (3, True, "other", "sent", "s", "r")], "id int, suppressed boolean, suppress_reason string, disposition string, ruled_out_stage string, ruled_out_reason string")
    rows, outcome = state.toggle_stale(flags, spark.createDataFrame([(1,), (3,), (3,), (9,), (None,)], "id int"))
    assert sorted(map(tuple, outcome.collect())) == [(1, "cleared"), (3, "flagged"), (9, "not_found")]
    assert [tuple(r)[:5] for r in rows.orderBy("id").collect()] == [(1, False, None, "in_play", None), (2, False, None, "in_play", None), (3, True, "left_employer", "ruled_out", "left_employer")]


def test_fused_people(spark):
    """Hand cases of each rank; a page may be null, a listing may tell nothing."""
    ld = lambda **x: '<script type="application/ld+json">' + json.dumps({"@type": "Person", **x}) + "</script>"
    card = lambda name, role="Manager": f'<div class="team"><h3>{name}</h3><p>{role}</p></div>'
    pages = {
        1: ld(name="Ann Lee", jobTitle=" ") + card("Bo Ray") + card("ann LEE") + "<p>ab.one@site.test cd.two@site.test sales@site.test",  # the site's own
        2: ld(name="Ann Lee") + card("Bo de Ray") + "<p>ab_one@wide.test bo@gmail.com",  # all business addresses
        3: ld(name="Ann Lee", email="Ann.Lee@gmail.com") + card("Bo Ray"),  # structured data, free mail among it
        4: ld(name="Cher") + card("Bo Ray"),  # the listing's domain, even free mail's
        5: ld(name="Ann Lee") + card("Bo Ray"),  # nothing
        6: card("Bo Ray") + card("Di Elm") + "<p>bray@site.test d.elm@site.test diel@site.test",  # one matched, one guessed
        7: None,
    }
    listing = [(1, "https://www.site.test/x", None), (2, "https://site.test", None), (3, None, ""), (4, "site.test", " Hello@Gmail.com"), (5, None, "no address"), (6, "http://site.test", "x@site.test"), (7, "https://a.test", "jo.fox@a.test"), (8, None, None)]
    dealers = spark.createDataFrame(listing, "id long, website_url string, api_email string")
    got = fusion.fuse_people(spark.createDataFrame([(i, "https://s.test/", h) for i, h in pages.items()], "id long, url string, html string"), dealers)
    assert {(r.id, r.full_name): (r.email, r.email_pattern, r.confidence, r.found_in) for r in got.collect()} == {
        (1, "Ann Lee"): ("ann.lee@site.test", "first.last", "inferred", "jsonld"), (1, "Bo Ray"): ("bo.ray@site.test", "first.last", "inferred", "page"),
        (1, "Ab One"): ("ab.one@site.test", None, "direct", "address"), (1, "Cd Two"): ("cd.two@site.test", None, "direct", "address"),
        (2, "Ann Lee"): ("ann_lee@wide.test", "first_last", "inferred", "jsonld"), (2, "Bo de Ray"): ("bo_deray@wide.test", "first_last", "inferred", "page"),
        (2, "Ab One"): ("ab_one@wide.test", None, "direct", "address"),
        (3, "Ann Lee"): ("ann.lee@gmail.com", None, "direct", "jsonld"), (3, "Bo Ray"): ("bo.ray@gmail.com", "first.last", "inferred", "page"),
        (4, "Cher"): (None, None, "direct", "jsonld"), (4, "Bo Ray"): ("bo.ray@gmail.com", None, "inferred", "page"),
        (5, "Ann Lee"): (None, None, "direct", "jsonld"), (5, "Bo Ray"): (None, None, "direct", "page"),
        (6, "Bo Ray"): ("bray@site.test", "first", "direct", "page"), (6, "Di Elm"): ("di@site.test", "first", "inferred", "page"),
        (7, "Jo Fox"): ("jo.fox@a.test", None, "direct", "address"),
    }
    none = fusion.fuse_people(spark.createDataFrame([], "id long, url string, html string"), dealers)
    assert [r.email for r in none.collect()] == ["x@site.test", "jo.fox@a.test"][1:]


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_counts_of_releases_read_once(spark):
    shown = "<p>Acme has appointed Jane Doe as Sales Manager.</p><p>Ann Example ann.example@acme.test</p>"
    rows = [(1, "Acme", "named", shown, None, 1), (2, "Acme", "named", shown.replace("Ann Example", "Jane Doe").replace("ann.example", "jane.doe"), None, 2), (3, "Acme", "named", shown.replace("Jane Doe", "Al Oak"), None, 3), (4, "x", None, None, None, 4)]
    table = spark.createDataFrame(rows, "release_id int, client_name string, title string, content_html string, release_date string, list_pos int")
    counts = release.release_counts(table)
    assert counts.first().asDict() == {"releases": 3, "missing": 1, "candidates": 3, "contacts": 2, "appointment_releases": 3, "appointees_named": 3, "extrapolated": 1}
    assert plan_of(counts).count("MapInArrow") == 1 and "Join" not in plan_of(counts)
    nothing = release.release_counts(table.filter("release_id > 9")).first().asDict()
    assert set(nothing.values()) == {0} and len(nothing) == 7


def test_counts_of_whole_texts(spark):
    """Appointments far behind the start of a text count as others do, each person once, with their guesses."""
    many = "".join(f"Acme has appointed Jane {chr(65 + k // 26)}{chr(97 + k % 26)}e. " for k in range(500)) * 2
    far = "<p>" + "Nothing new in the yard. " * 300 + f"</p><p>{many}</p><p>Ann Example ann.example@acme.test</p>"
    table = spark.createDataFrame([(1, "Acme", "Changes", far, None, 1)], "release_id int, client_name string, title string, content_html string, release_date string, list_pos int")
    assert release.release_counts(table).first().asDict() == {"releases": 1, "missing": 0, "candidates": 1, "contacts": 1, "appointment_releases": 1, "appointees_named": 500, "extrapolated": 500}


def test_messages_in_small_batches(spark):
    raw = spark.createDataFrame([(k, f"Subject: out of office\nAuto-Submitted: auto-replied\nFrom: =?utf-8?q?J=C3=B6?= <U{k}@a.test>\n\nask jane.doe@b{k}.test") for k in range(250)] + [(250, None)], "msg_id int, raw string")
    for kind, frame in ("classify", mail.classify(mail.parse_messages(raw, body=False))), ("people", mail.harvest_replies(mail.parse_messages(raw))):
        # Arrow would take ten thousand whole messages at a time, whatever their length
        assert plan_of(frame).count("BatchEvalPython") == 1 and "MapIn" not in plan_of(frame) and "ArrowEval" not in plan_of(frame), kind
        assert frame.filter("email is not null").count() == 250
    assert mail.parse_messages(raw).filter("msg_id = 7").first().sender == "Jö <U7@a.test>"
    assert "body" not in mail.parse_messages(raw, body=False).columns


@pytest.mark.parametrize("name", ["reply_mails", "releases"])
def test_texts_are_made_in_many_tasks(spark, name):
    rows = domain(spark, SF, name)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 8  # one file of one row group


def test_appointments_read_once(spark):
    from brambler.queries import QUERIES

    for query in ("appointments", "appointee_addresses"):
        plan = plan_of(QUERIES[query](spark, SF))
        assert plan.count("MapInArrow") == 1 and "Join" not in plan, query
