import datetime
import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from provenant.operators import discovery, planning, policy, responses, retrieval
from provenant.sources.captures import decoded
from provenant.sources.manifest import ManifestError, load_manifest, parse_manifest

OK, SCOPE, HOST, SCHEME, WRAP = None, policy.SCOPE, policy.HOST, policy.SCHEME, policy.WRAPPER
H = "https://docs.testreg.example"
URLS = [
    (f"{H}/files/a.pdf", OK), (f"{H}:443/files/a.pdf", OK), (f"{H}:/files/a.pdf", OK), ("HTTPS://DOCS.testreg.example./files/a.pdf", OK), (f"{H}/files/a.pdf#x", OK),
    (None, SCOPE), ("", SCOPE), (f"{H}/files/{'a' * 200}", SCOPE), (f"{H}/files/a b", SCOPE), (f"{H}/files\\a", SCOPE), (f"{H}/files/\x7f", SCOPE),
    ("http://docs.testreg.example/files/a", SCHEME), ("//docs.testreg.example/files/a", SCHEME), ("https:/docs.testreg.example/files/a", SCHEME), ("ftp://docs.testreg.example/a", SCHEME),
    ("https://u@docs.testreg.example/files/a", HOST), (f"{H}:8443/files/a", HOST), (f"{H}:x/files/a", HOST), ("https:///files/a", HOST), ("https://127.0.0.1/files/a", HOST), ("https://0x7f.1/files/a", HOST),
    ("https://2130706433/files/a", HOST), ("https://[::1]/files/a", HOST), ("https://evil.example/files/a", HOST), ("https://docs.testreg.example.evil.example/files/a", HOST),
    (f"{H}/web/?file=x", WRAP), (f"{H}/web?file=x", WRAP), (f"{H}/web/", SCOPE), (f"{H}/files/é", SCOPE), (f"{H}/files/%2fa", SCOPE), (f"{H}/files/%5Ca", SCOPE), (f"{H}/files/%2561", SCOPE),
    (f"{H}/files/%0aa", SCOPE), (f"{H}/files/../a", SCOPE), (f"{H}/files/%2e%2e/a", SCOPE), (f"{H}/files//a", SCOPE), (f"{H}/other/a", SCOPE), (f"{H}/filesystem/a", SCOPE), (f"{H}/files/a?x=1", SCOPE),
]


def test_url_policy(spark):
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URLS)], "i int, u string")
    got = {r.i: r.reason for r in rows.select("i", policy.url_reason(F.col("u"), ["docs.testreg.example"], ["/files/"], 200).alias("reason")).collect()}
    assert [(u, got[i]) for i, (u, _) in enumerate(URLS)] == URLS
    (r,) = spark.range(1).select(policy.url_reason(F.lit(f"{H}/list?p=1"), ["docs.testreg.example"], ["/list"], 200, [f"{H}/list?p=1"]).alias("a"), policy.redirect_reason(F.lit(HOST), F.lit(1)).alias("b")).collect()
    assert r.a is None and r.b == policy.OFF_ALLOWLIST


def test_addresses(spark):
    cases = {"8.8.8.8": True, "10.1.2.3": False, "172.32.0.1": True, "100.64.0.1": False, "1.2.3": False, "1.2.3.256": False, "01.2.3.4": False, "2606:4700::1111": True, "::1": False, "::ffff:8.8.8.8": False, "fe80::1%eth0": False, "2002:808:808::": False}
    rows = spark.createDataFrame([(a,) for a in cases], "a string").select("a", policy.public_v4(F.col("a")).alias("v4"), policy.public_address("a").alias("both")).collect()
    assert {r.a: r.both for r in rows} == cases and all(r.v4 == cases[r.a] for r in rows if ":" not in r.a)
    (r,) = spark.sql("select array('8.8.8.8', '10.0.0.1') a, array('8.8.8.8') b, cast(array() as array<string>) c").select(*(policy.answers_public(F.col(c)).alias(c) for c in "abc")).collect()
    assert (r.a, r.b, r.c) == (False, True, False)


def test_log_hygiene(spark):
    out = spark.createDataFrame([("a\nb\x85\u2028key é", "https://u:p@H.example/p?q#f"), ("x" * 20, "no url")], "t string, u string").select(policy.neutralised(F.col("t"), 15, ["key"]).alias("t"), policy.neutralised(F.col("t"), 99, ["key"]).alias("long"), policy.log_url(F.col("u")).alias("u")).collect()
    assert out[0].long == "a\\x0ab\\x85\\u2028[REDACTED] é" and len(out[0].t) == 15 and out[1].t == "x" * 14 + "…"
    assert [r.u for r in out] == ["https://h.example/p", "[unparseable-url]"]
    (h,) = spark.sql("select map('ETag', 'x', 'Set-Cookie', 'y', 'content-type', 'z') h").select(policy.safe_headers(F.col("h")).alias("h")).collect()
    assert h.h == {"etag": "x", "content-type": "z"}


def test_responses(spark):
    pdf = b"%PDF-1.4 body %%EOF"
    cases = [
        ("application/pdf", pdf, "ATTACHMENT", None), ("text/html", b"<html>", "ATTACHMENT", "CONTENT_TYPE_MISMATCH"), ("application/pdf", b"", "ATTACHMENT", "MAGIC_BYTES_MISMATCH"), ("application/pdf", b"%PDF-1.4", "ATTACHMENT", "PDF_SANITY_FAILED"),
        ("application/pdf", b"%PDF- /JavaScript %%EOF", "ATTACHMENT", "PDF_SANITY_FAILED"), ("application/pdf", b"%PDF- /JSON %%EOF", "ATTACHMENT", None), ("application/pdf", pdf + b"x" * 500, "ATTACHMENT", "SIZE_EXCEEDED"), ("Text/HTML; a=b", b"x", "DETAIL_PAGE", None),
    ]
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, ct string, body binary, p string")
    got = {r.i: r.x for r in rows.select("i", responses.rejection(F.col("ct"), F.col("body"), F.col("p"), 400, 64).alias("x")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]
    now = F.lit(datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc))
    values = {"5": 5.0, "-1": None, "1234567890123": None, "Thu, 01 Jan 2026 00:01:00 GMT": 60.0, "Wed, 31 Dec 2025 00:00:00 GMT": 0.0, "soon": None}
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", responses.retry_after_seconds(F.col("v"), now).alias("s")).collect()
    assert {r.v: r.s for r in got} == values
    chain = spark.sql("select array('a','b','a') x, array('a','b') y, array('a','b','c') z").select(*(responses.redirect_problem(F.col(c), 1).alias(c) for c in "xyz")).first()
    assert tuple(chain) == ("REDIRECT_LOOP", None, "TOO_MANY_REDIRECTS")


def test_body_decoding():
    assert decoded("gzip", gzip.compress(b"abc"), 10) == decoded(None, b"abc", 10) == decoded("deflate", zlib.compress(b"abc"), 10)
    assert decoded("gzip", gzip.compress(b"a" * 99), 10)[2] == "SIZE_EXCEEDED" and decoded("gzip", gzip.compress(b"abc")[:-6], 10)[2] == "PDF_SANITY_FAILED"
    assert decoded("br", b"x", 10)[2] == "CONTENT_TYPE_MISMATCH" and decoded("gzip", None, 10) == (None, None, None)


def test_references(spark):
    html = """<a href=" /x ">1</a><!-- <a href="/no"> --><script>'<a href="/no">'</script><img src="/no"><iframe src='f'></iframe><embed src=e><object data="o&amp;p"></object><A HREF="b" href="c"><a href=" "><link href="/no">"""
    (row,) = spark.createDataFrame([(html,)], "html string").select(discovery.listed_attributes("html").alias("rows")).select(discovery.references(F.col("rows")).alias("found")).collect()
    assert row.found == ["/x", "f", "e", "o&p", "b"]
    tails = ("file=https%3A%2F%2Fh%2Fa.pdf", "file=a&file=b", "file=", "x=1", "file=%zz", "file=%ff", "file=%ef%bf%bd")
    rows = spark.createDataFrame([(i, f"https://h/web/?{q}") for i, q in enumerate(tails)], "i int, u string").select("i", *discovery.embedded(F.col("u"))).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == [("https://h/a.pdf", None), *((None, p) for p in ("VIEWER_FILE_REPEATED", "VIEWER_FILE_MISSING", "VIEWER_FILE_MISSING", "MALFORMED_PERCENT_ENCODING", "MALFORMED_PERCENT_ENCODING")), ("\ufffd", None)]


def test_discovery_status(spark):
    pages = spark.createDataFrame([(1, f"{H}/p", '<a href="/files/a"><a href="../files/a"><a href="/no">'), (2, f"{H}/p", '<a href="/files/a"><a href="/files/b">'), (3, f"{H}/p", "none"), (4, None, None)], "page_id int, url string, html string")
    refs = discovery.page_references(pages)
    status = discovery.discovery_status(pages, refs, policy.url_reason(F.col("resolved"), ["docs.testreg.example"], ["/files/"], 200).isNull())
    assert {r.page_id: r.status for r in status.collect()} == {1: "DISCOVERED", 2: "AMBIGUOUS", 3: "UNRESOLVED", 4: "UNRESOLVED"}


def test_selection(spark):
    table = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "document_key string, x int")
    assert [(r.position, r.x) for r in planning.selected(spark, table, ["C", "A"]).orderBy("position").collect()] == [(1, 3), (2, 1)]
    for keys, code in ((None, "REQUIRED"), ([], "EMPTY"), ("A", "NOT_A_SEQUENCE"), ([1], "NON_STRING_KEY"), (["A", "A"], "DUPLICATE_KEY"), (["Z"], "UNKNOWN_KEY")):
        with pytest.raises(planning.SelectionError) as error:
            planning.selected(spark, table, keys)
        assert error.value.code == f"SELECTION_{code}"


def test_gate(spark):
    rows = spark.createDataFrame([(True, "DONE", "x", "2026"), (False, "BLOCKED", " ", None)], "ingestion_authorized boolean, review_status string, reviewed_by string, reviewed_at string")
    assert [len(r[0]) for r in rows.select(planning.gate_reasons()).collect()] == [0, 4]


MANIFEST = """source_id: s
allowed_hosts: [docs.testreg.example]
crawl: {parameters: {min_delay: 1.0}}
candidates:
- {document_key: B-2, tier: primary, title: t, document_type: circular, listing_date: 2026-01-05, url_status: OBSERVED}
- {document_key: A-1, tier: primary, title: t, document_type: circular}
"""


def test_manifest(spark):
    m = parse_manifest(MANIFEST.encode())
    assert [r.document_key for r in m.candidates_frame(spark).collect()] == ["A-1", "B-2"] and len(m.manifest_hash) == 64
    for old, new in (("A-1", "B-2"), ("A-1", "-x"), ("OBSERVED", "observed"), ("2026-01-05", "2026-01-05T00:00:00"), ("docs.testreg.example", "*.example"), ("source_id: s", "source_id: s\nsource_id: t"), ("source_id: s", "source_id: &a s"), ("1.0", "true"), ("docs.testreg.example", "10.0.0.1")):
        with pytest.raises(ManifestError):
            parse_manifest(MANIFEST.replace(old, new).encode())
    with pytest.raises(ManifestError):
        parse_manifest(b"\xff")


def test_text_units(spark):
    docs = spark.createDataFrame([(1, "ab\n\ncdé"), (2, ""), (3, None)], "doc_id long, text string")
    got = [(r.doc_id, r.node, r.start, r.end) for r in retrieval.chunks(docs).collect()]
    assert got == [(1, 0, 0, 2), (1, 2, 4, 7)]
    (r,) = spark.range(1).select(retrieval.trigram_similarity(F.lit("word"), F.lit("words")).alias("s"), retrieval.visible(F.lit("a\u200bb\x00")).alias("v"), retrieval.nfkc_folded(F.lit("ﬁX")).alias("n")).collect()
    assert abs(r.s - 4 / 7) < 1e-9 and r.v == "ab" and r.n == "fix"


COMPLETE = """manifest_version: "1"
source_id: s
authority: a
domain: {jurisdiction: X, regulator: Y, corpus: Z}
access_review: {status: BLOCKED, reviewed_by: null, open_items: [one]}
ingestion_authorized: false
allowed_hosts: [docs.testreg.example]
allowed_url_policy: {schemes: [https], allowed_methods: [GET], path_prefixes: {listing: [/l], detail: [/d/], attachment: [/files/]}}
listing_urls: [{url: "https://docs.testreg.example/l"}]
document_types: [circular]
bounded_date_window: {from: 2026-01-01, to: 2026-12-31}
crawl: {status: CONFIGURED, user_agent_contact: "env:CONTACT", min_delay_seconds: 1.5, max_redirects: 3, backoff_base_seconds: 1, backoff_max_seconds: 8}
candidate_documents:
- {document_key: A-1, tier: primary, title: t, document_type: circular, sampled: true, resolution_status: open, url_status: OBSERVED}
"""


def test_complete_manifest(tmp_path, spark):
    (tmp_path / "m.yaml").write_text(COMPLETE)
    m = load_manifest(tmp_path / "m.yaml", complete=True)
    assert m.parameters == {"min_delay_seconds": 1.5, "max_redirects": 3, "backoff_base_seconds": 1, "backoff_max_seconds": 8} and m.candidate_key("A-1") == "s/A-1"
    (row,) = m.candidates_frame(spark).collect()
    assert row.sampled and row.resolution_status == "open" and [tuple(x) for x in row.status_labels] == [("url_status", "OBSERVED")]
    for old, new in (
        ("[https]", "[http]"), ("[GET]", "[POST]"), ("[GET]", "[]"), ("attachment: [/files/]", "other: [/files/]"), ("BLOCKED", "FINE"), ("false", '"no"'), ("env:CONTACT", "me@x.example"), ("min_delay_seconds: 1.5", "min_delay: 1"),
        ("max_redirects: 3", "max_redirects: 2.5"), ("max_redirects: 3", "max_redirects: true"), ("backoff_max_seconds: 8", "backoff_max_seconds: 0.5"), ("sampled: true", "sampled: 1"), ("2026-12-31", "2026-13-31"), ("authority: a\n", ""),
        ('"https://docs', '"http://docs'), ("domain: {", "domain: {<<: {}, "), ("[circular]", "[*x]"), ("title: t,", "title: t, title: u,"),
    ):
        assert old in COMPLETE
        with pytest.raises(ManifestError):
            parse_manifest(COMPLETE.replace(old, new, 1).encode(), complete=True)
    with pytest.raises(ManifestError):
        load_manifest(tmp_path / "none.yaml")


def test_run_is_refused_before_anything_is_sent(spark):
    from provenant.operators import ingest

    rows = spark.createDataFrame([("A", 1), ("B", 2)], "document_key string, x int")
    good = {"ingestion_authorized": True, "review_status": "DONE", "reviewed_by": "x", "reviewed_at": "2026", "crawl_status": "CONFIGURED", "parameters": {"p": 1}, "contact": "c"}
    run = lambda keys, mode="LIVE", ref="r", **change: ingest.admitted_candidates(spark, rows, good | change, keys, mode, ref, ["p"])
    assert run(None)[1:3] == ("POLICY_VIOLATION", "candidate selection refused: SELECTION_REQUIRED")
    assert run(["A"], ingestion_authorized=False, reviewed_by=" ")[1:3] == ("GATE_CLOSED", "INGESTION_NOT_AUTHORIZED, NO_REVIEWER")
    assert run(["A"], parameters={}, crawl_status="DRAFT")[2] == "required safety parameters are unset: crawl.status, p"
    assert run(["A"], contact=None)[1] == run(["A"], ref=None)[1] == "POLICY_VIOLATION"
    for mode in ("LIVE", "DRY_RUN"):
        status, reason, problem, chosen = run(["B", "A"], mode)
        assert (status, reason, problem) == ("RUNNING", None, None) and [r.document_key for r in chosen.orderBy("position").collect()] == ["B", "A"]
    assert run(["A"], "DRY_RUN", ref=None, ingestion_authorized=False)[0] == "RUNNING"


def test_refused_appends(spark, tmp_path):
    from provenant.sources import commits, ledger

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ledger.ConflictError):
        ledger.append_audit(spark, f"file://{tmp_path}/t", rows.union(rows), ["k"], 1, rows.limit(0).select("k"))
    with pytest.raises(ledger.ConflictError):
        ledger.append_audit(spark, f"file://{tmp_path}/t", rows, ["k"], 1, rows.filter("k = 2").select("k"))
    assert ledger.append_audit(spark, f"file://{tmp_path}/t", rows, ["k"], 1, rows.limit(0).select("k")).count() == 2
    bodies = spark.createDataFrame([(bytearray(b"x"),)], "body binary")
    for a, b in (("/s", "/s/q"), ("/s/q", "/s"), ("/s", "/s/")):
        with pytest.raises(ledger.ConflictError):
            ledger.put_quarantined(spark, f"{tmp_path}{a}", f"{tmp_path}{b}", bodies, 1)
    path = f"file://{tmp_path}/blobs"
    assert ledger.put_blobs(spark, path, bodies, 1).count() == 1 and ledger.put_blobs(spark, path, bodies, 2).count() == 0
    stored = ledger.read_table(spark, path, ledger.BLOBS).withColumn("body", F.encode(F.lit("y"), "UTF-8"))
    commits.commit(spark, path, "by another way", {ledger.ROWS: stored}, {ledger.ROWS: "prefix"})
    with pytest.raises(ledger.ConflictError):
        ledger.put_blobs(spark, path, bodies, 4)


def test_scratch_folder_follows_the_file_system(spark, tmp_path):
    from provenant import session

    conf = spark._jsc.hadoopConfiguration()
    default = conf.get("fs.defaultFS")
    try:
        assert session.qualified(spark, f"{tmp_path}/shared/") == f"file:{tmp_path}/shared"
        conf.set("fs.defaultFS", "viewfs://cluster/")
        conf.set("fs.viewfs.mounttable.cluster.link./shared", f"file://{tmp_path}")
        assert session.qualified(spark, "/shared/a") == "viewfs://cluster/shared/a"
        assert session.qualified(spark, f"file://{tmp_path}/b") == f"file:{tmp_path}/b"
    finally:
        conf.set("fs.defaultFS", default)


def test_scratch_folder_is_not_guessed_on_a_cluster():
    from types import SimpleNamespace as Fake

    from provenant import session

    none = Fake(isDefined=lambda: False)
    context = Fake(master="yarn", _jsc=Fake(sc=lambda: Fake(getCheckpointDir=lambda: none)))
    with pytest.raises(ValueError):
        session.checkpoint_dir(Fake(conf=Fake(get=lambda name, default: default), sparkContext=context))
