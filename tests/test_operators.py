import random

import pytest
from pyspark.sql import functions as F

from leadweave.operators import contacts, store
from leadweave.operators.export import greedy
from leadweave.session import Pointer, work_path
from leadweave.sources import readers


def sequential(rows):
    mails, orgs, kept = set(), set(), []
    for seq, mail, org in sorted(rows):
        if mail not in mails and org not in orgs:
            mails.add(mail), orgs.add(org), kept.append(seq)
    return kept


def test_greedy(spark):
    case = [(1, "m1", "o1"), (2, "m1", "o2"), (3, "m2", "o2"), (4, "m2", "o3"), (5, "m5", "o3")]
    rng = random.Random(3)
    rnd = [(i, f"m{rng.randrange(12)}", f"o{rng.randrange(12)}") for i in range(60)]
    for rows in (case, rnd, []):
        df = spark.createDataFrame(rows, "seq int, mail string, org string")
        assert sorted(r[0] for r in greedy(df).collect()) == sequential(rows)


def clean(spark, mails, domain, strict=False):
    df = spark.createDataFrame([(mails, domain)], "m array<string>, d string")
    return df.select(contacts.clean_mails(F.col("m"), F.col("d"), strict)).first()[0]


def test_cleaner(spark):
    assert clean(spark, ["<Info@Firm.nl>,", "anna@firm.nl", None], "firm.nl") == ["info@firm.nl", "anna@firm.nl"]
    assert clean(spark, ["noreply@firm.nl", "logo@2x.png", "x@other.nl", "a" * 90 + "@firm.nl"], "firm.nl") == []
    assert clean(spark, ["x@other.co.uk"], "a.co.uk") == ["x@other.co.uk"]
    assert clean(spark, ["x@gmail.com", "y@sub.firm.nl"], "firm.nl") == ["x@gmail.com", "y@sub.firm.nl"]
    assert clean(spark, [], "firm.nl") == []


PAGES = "domain string, scheme string, ord int, path string, http_status int, error string, html string"


def site(spark, *pages):
    return contacts.extract_sites(spark.createDataFrame([("d.nl", *p) for p in pages], PAGES)).first()


def test_site_states(spark):
    hit = "<a>info@d.nl</a>"
    assert site(spark, ("https", 0, "", 200, None, "x"), ("https", 1, "/contact", 200, None, hit))[1:] == ("done", "info@d.nl", "info@d.nl", "bulundu: /contact")
    assert site(spark, ("https", 0, "", 404, None, None), ("http", 19, "", 200, None, hit)).status == "noemail"
    assert site(spark, ("https", 0, "", 503, None, None), ("http", 19, "", 200, None, hit)).status == "error"
    assert site(spark, ("https", 0, "", None, "Timeout", None), ("http", 19, "", 200, None, hit)).note == "bulundu: /"
    assert site(spark, ("https", 0, "", 200, None, "x@other.de"), ("https", 1, "/a", None, "Timeout", None), ("http", 19, "", 200, None, hit)).status == "error"


def test_store(spark):
    s = store.Snapshots(spark, work_path(spark, "t"))
    rows = spark.createDataFrame([(1, "A.nl", "x"), (2, "www.a.nl", "y"), (3, "wix.com", "z"), (4, None, "n")], "seq long, domain string, name string")
    assert s.insert(rows) == 1 and s.insert(rows) == 0
    assert [(r.domain, r.name, r.status) for r in s.read().collect()] == [("a.nl", "x", "pending")]
    new = spark.createDataFrame([(1, "b.nl", "q")], "seq long, domain string, name string")
    assert s.insert(new) == 1 and s.read().filter("domain = 'b.nl'").first().seq == 2
    # another process finds the same store; a version whose file isn't there doesn't count
    again = store.Snapshots(spark, s.path)
    new.write.parquet(f"{s.path}/v3-broken")
    assert again.version() == 2 and again.read().count() == 2 and again.buckets == s.buckets
    found = spark.createDataFrame([("b.nl", "done", "x@b.nl", "x@b.nl", "n"), ("c.nl", "done", "x@c.nl", "", "")], "domain string, status string, email string, all_mails string, note string")
    before = {r.domain: r.checked_at for r in again.read().collect()}
    assert again.apply(found) == 1 and again.apply(found.limit(0)) == 0
    rows = {r.domain: r for r in again.read().collect()}
    assert rows["b.nl"].email == "x@b.nl" and rows["b.nl"].checked_at is not None and rows["a.nl"].checked_at == before["a.nl"] and s.version() == 3


def test_store_folds_small_parts(spark):
    s = store.Snapshots(spark, work_path(spark, "t"), buckets=1, parts=2)
    for k in range(4):
        assert s.insert(spark.createDataFrame([(1, f"d{k}.nl")], "seq long, domain string")) == 1
    assert sorted((r.seq, r.domain) for r in s.read().collect()) == [(k + 1, f"d{k}.nl") for k in range(4)]
    assert len(s.pointer.read()[1]["parts"]["0"]) <= 2


def test_one_writer_a_version(spark):
    p = Pointer(spark, work_path(spark, "t"))
    p.write(1, {"a": 1})
    with pytest.raises(FileExistsError):
        p.write(1, {"a": 2})
    assert p.read() == (1, {"a": 1})


def test_crawl(spark):
    queue = spark.createDataFrame([("x@gmail.com",), ("d.nl",), ("e.nl",), (None,), ("d.nl",)], "domain string")
    pages = spark.createDataFrame([("d.nl", "https", 0, "", 200, None, "info@d.nl")], PAGES)
    got = {r.domain: tuple(r)[1:] for r in contacts.crawl(queue, pages).collect()}
    assert got == {"x@gmail.com": ("done", "x@gmail.com", "x@gmail.com", "kaynak etiketinden"), "d.nl": ("done", "info@d.nl", "info@d.nl", "bulundu: /"), "e.nl": ("noemail", None, "", "")}
    assert tuple(contacts.crawl_counts(contacts.crawl(queue, pages)).first()) == (3, 2)


def test_verifier(spark):
    page = "domain string, path_idx int, url string, http_status int, error string, html string"
    hidden = '<a data-cfemail="5a' + "".join(f"{ord(c) ^ 0x5A:02x}" for c in "b@y.nl") + '">'
    pages = spark.createDataFrame([
        ("x.nl", 0, "https://x.nl", 200, None, "A@x.nl"), ("x.nl", 12, "https://x.nl/about-us", 200, None, "late@x.nl"), ("y.nl", 3, "https://y.nl/c", 200, None, hidden),
        ("z.nl", 0, "https://z.nl", 200, "Timeout", "a@z.nl"), ("list.nl", 15, "https://list.nl/1", 200, None, "a@z.nl"), ("w.nl", 0, "https://w.nl", 404, None, "a@w.nl"),
    ], page)
    claims = [
        (1, "a@x.nl", "https://x.nl", None), (2, "late@x.nl", "x.nl", ""), (3, " B@Y.nl", "y.nl", None), (4, "a@z.nl", "z.nl", None), (5, "a@z.nl", "z.nl", "https://list.nl/1"),
        (6, "a@z.nl", " ", "https://list.nl/1"), (7, "a@w.nl", "w.nl", None), (8, None, "x.nl", None), (9, "q@q.nl", "w.nl", "https://list.nl/1"), (10, "late@x.nl", "x.nl", "https://x.nl/about-us"),
    ]
    df = spark.createDataFrame(claims, "row_id long, email string, website string, source_url string").withColumn("company", F.lit("Firm"))
    got = {r.row_id: r.outcome for r in contacts.verify_claims(df, pages).collect()}
    ok, no, gone, none = "DOGRULANDI", "sitede-yok", "erisilemedi", "site-yok"
    assert got == {1: ok, 2: no, 3: ok, 4: gone, 5: ok, 6: none, 7: gone, 8: no, 9: no, 10: ok}
    kept, counts = contacts.verify_list(df, pages, ["y.nl", "x(nl"])
    assert {r.row_id for r in kept.collect()} == {1, 5, 10} and kept.columns == df.columns
    assert {r.what: r.n for r in counts.collect()} == {"total": 10, "banned": 1, "candidates": 9, ok: 3, no: 3, gone: 2, none: 1}


def test_csv_keeps_its_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"p{k}.csv").write_text("a,b\n" + "".join(f'{k},"x\n{i}"\n' for i in range(k + 2)))
    got = [(r.seq, r.a, r.b) for r in readers.read_csv(spark, str(tmp_path), ["a", "b"], order="seq").orderBy("seq").collect()]
    assert got == [(n, str(k), f"x\n{i}") for n, (k, i) in enumerate((k, i) for k in range(3) for i in range(k + 2))]


def test_harvest(spark):
    e = lambda **tags: ("node", 1, {"office": "consulting", **tags})
    rows = [(1, "DE", 0, "A", []), (1, "DE", 1, "A2", [e(website="a.de", name="N"), e(email="x@a.de"), e(email="bad")]), (2, "DE", 0, "B", [e(website="a.de", email="i@a.de"), ("relation", 2, {"office": "consulting", "website": "r.de"})]), (3, "FR", 0, "C", [e(website="c.fr")]), (4, "NL", 0, "D", [])]
    df = spark.createDataFrame(rows, f"ord long, country string, pos int, name string, {readers.RESPONSE}")
    h = readers.harvest(df, "de, nl")
    got = sorted((r.domain, r.name, r.city, r.source, r.status, r.email) for r in readers.harvested_leads(h).collect())
    assert got == [("a.de", "N", "A2", "osm:A2", "done", "i@a.de"), ("x@a.de", "", "A2", "osm:A2", "done", "x@a.de")]
    assert readers.harvest(df).select("country").distinct().count() == 2
    none = spark.createDataFrame([], "domain string")
    counts = {r.ord: (r.elements, r.ready, r.new) for r in readers.harvest_counts(h, none).collect()}
    assert counts == {1: (2, 1, 2), 2: (1, 1, 0), None: (3, 2, 2)}
    assert readers.harvest_counts(h, spark.createDataFrame([("a.de",)], "domain string")).filter("ord is null").first().new == 1


def test_csv(spark):
    at = work_path(spark, "csv")
    rows = [('a "b", c', " x ", "l1\nl2"), ("", "ü", "-")]
    readers.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), at)
    assert sorted(map(tuple, readers.read_csv(spark, at, ["a", "b", "c"]).collect())) == sorted([('a "b", c', " x ", "l1\r\nl2"), ("", "ü", "-")]) or sorted(map(tuple, readers.read_csv(spark, at, ["a", "b", "c"]).collect())) == sorted(rows)
    assert readers.read_csv(spark, at + "-missing", ["a"]).count() == 0


def test_responses(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"elements": [{"type": "node", "id": 1, "tags": {"office": "accountant", "name": "N", "website": "a.nl"}}, {"type": "relation", "id": 2, "tags": {"office": "accountant", "email": "x@b.nl"}}]}')
    e = readers.read_responses(spark, str(tmp_path)).withColumn("seq", F.col("id"))
    assert [(r.domain, r.name, r.status) for r in readers.ingest_osm(e, "X").collect()] == [("a.nl", "N", "pending")]
