"""The methods against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadweave.llm.edit import damerau
from leadweave.llm.fold import canon_word
from leadweave.llm import canonical_map as cm
from leadweave.llm import firms, known, ledger, leakage, mixture, safety, text, variants
from leadweave.llm.matching import FULL, ROOTS, calibrate, candidates, loose_terms, reading_terms
from leadweave.llm.spelling import FEW, RATIO, Spelling

CITIES = [(1, "DE", ["Skiskerhafen"]), (2, "NL", ["Bad Noldalk", "Glurnixford"]), (3, "CH", ["Mindrot am See"]), (4, "BG", ["Skoruxford"]), (5, "NL", ["Skoruxford"]), (6, "NL", ["Sint Turguldijk"]), (7, "TR", ["Bindröltepe"])]
CODES = {"de": "DE", "germany": "DE", "nl": "NL", "bg": "BG", "ch": "CH", "tr": "TR", "netherlands": "NL"}


@pytest.mark.parametrize(
    ("typed", "country", "want"),
    [
        ("skiskerhafen", "DE", 1), ("Skiskerh.", "DE", 1), ("Skiskerahfen", None, 1), ("DE-39344 Skiskerhafen", "DE", 1), ("Skiskerhafen (Germany)", "", 1), ("Raum Skiskerhafen", "DE", 1),
        ("Noldalk", "NL", 2), ("Bad-Noldalk", "NL", 2), ("Glurnixford", "NL", 2), ("Mindrot", "CH", 3), ("Mindrot-am-See Altstadt", "CH", 3), ("SKORUXFORD", "BG", 4), ("Skoruxfrd", "NL", 5),
        ("Skoruxford / NL", None, 5), ("St. Turguldijk", "NL", 6), ("BindrÃ¶ltepe", "TR", 7), ("city of Bindroltepe", "TR", 7), ("bundesweit", "DE", -1), ("x", "DE", -1), ("-", "DE", -1), ("", "DE", -1), (None, None, -1),
        ("Hauptstr. 14", "DE", -1), ("Juntilkford", "NL", -1), ("y" * 10_000, "DE", -1), ("12345", "DE", -1),
    ],
)
def test_typed_towns(typed, country, want):
    assert cm.Matcher(CITIES, CODES).resolve(typed, country) == want


def test_typed_countries():
    m = cm.Matcher([(1, "DE", ["Germany", "Deutschland"]), (2, "AE", ["United Arab Emirates", "UAE"]), (3, "GB", ["United Kingdom"])], {}, True)
    for t, want in [("DE", 1), ("in Germany", 1), ("Gemrany", 1), ("U.A.E.", 2), ("the United Arab Emirates", 2), ("United Arab Emirates, Gulf", 2), ("U.K.", 3), ("EMEA", -1), ("Gulf region", -1), ("Germany - HQ", 1)]:
        assert m.resolve(t, None) == want, t


def test_sharded_list_gives_the_same(spark):
    words = ["skiskerhafen", "Skiskerahfen", "noldalk", "nowhere", "Mindrott am See", None, ""]
    df = spark.createDataFrame([(i, w, "DE") for i, w in enumerate(words)], "i int, v string, g string")
    ref = spark.createDataFrame([(i, g, ns[0], ns[1] if len(ns) > 1 else None) for i, g, ns in CITIES], "id long, g string, name string, other string")
    one = {r.i: r.ref_id for r in cm.map_list(df, "v", "g", ref, "id", "g", ["name", "other"]).collect()}
    many = {r.i: r.ref_id for r in cm.map_list(df, "v", "g", ref, "id", "g", ["name", "other"], max_broadcast=2).collect()}
    assert one == many


def test_sharded_lists_of_the_tables_give_the_same(spark, small):
    t = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    countries, cities = t("ref_countries"), t("ref_cities")
    codes = cm.country_codes(countries)
    for args in [
        (t("leads").select("seq", "city", "country"), "city", "country", cities, "city_id", "country", ["city", "other_name"], codes, False),
        (t("incoming_list").select("row_id", "country"), "country", None, countries, "country_id", "code", ["country", "other_names"], codes, True),
    ]:
        one = sorted(map(tuple, cm.map_list(*args).collect()), key=repr)
        many = sorted(map(tuple, cm.map_list(*args, max_broadcast=args[3].count() // 3).collect()), key=repr)
        assert one == many
    # a truncated value that begins entries of two shards denotes none
    ref = spark.createDataFrame([(i, "DE", f"Skisker{x}", None) for i, x in enumerate("abcdefgh")] + [(9, "DE", "Glurnix", None)], "id long, g string, name string, other string")
    df = spark.createDataFrame([("Skisk.", "DE"), ("Glur.", "DE"), ("Skiskera.", "DE")], "v string, g string")
    got = {r.v: r.ref_id for r in cm.map_list(df, "v", "g", ref, "id", "g", ["name", "other"], max_broadcast=2).collect()}
    assert got == {"Skisk.": -1, "Glur.": 9, "Skiskera.": 0}
    with pytest.raises(ValueError):
        cm.country_codes(countries, bound=3)


def test_ledger_equals_counting(spark):
    rng = random.Random(1)
    rows = [("s", i, rng.randrange(5), f"k{min(rng.randrange(60), 40)}") for i in range(400)]
    df = spark.createDataFrame(rows, "src string, id long, arrival int, t string").withColumn("key", F.unhex(F.md5("t"))).drop("t")
    book, total = ledger.replay(df, rounds=5)
    groups = defaultdict(list)
    for _, i, _, k in rows:
        groups[k].append(i)
    got = sorted((r.n, r.first_id) for r in book.read().collect())
    assert total == 400 and got == sorted((len(v), min(v)) for v in groups.values())
    pairs = {(r.first_id, r.id) for r in book.copies(df, total, hot=4).filter("id <> first_id").collect()}
    assert pairs == {(min(v), x) for v in groups.values() for x in v if x != min(v)}


def test_ledger_opens_again(spark):
    row = lambda *ks: spark.createDataFrame([(k, i) for k, i in ks], "t string, id long").select(F.unhex(F.md5("t")).alias("key"), "id")
    first = ledger.Ledger(spark, buckets=64)
    first.add(row(("a", 5), ("b", 6), ("a", 7)))
    again = ledger.Ledger(spark, first.path)
    assert again.buckets == 64
    before = dict(again.pointer.read()[1]["parts"])
    again.add(row(("a", 2)))
    after = again.pointer.read()[1]["parts"]
    # one bucket was written, the others stay as they are, and a step without a state file doesn't count
    assert len([b for b in after if before.get(b) != after[b]]) == 1
    row(("z", 1)).write.parquet(f"{first.path}/v9-broken/bucket=1")
    assert sorted((r.n, r.first_id) for r in ledger.Ledger(spark, first.path).read().collect()) == [(1, 6), (3, 2)]
    again.add(row())
    assert sorted((r.n, r.first_id) for r in first.read().collect()) == [(1, 6), (3, 2)]


def test_ledger_keys(spark):
    rows = [
        ("www.a-b.test", "A & B", "Town", "DE", "<info@a-b.test>"), ("INFO@a-b.test;", "a b", " town,", "de", "https://a-b.test/x"), ("a-b.test", "Ä & B", "Town", "DE", "info@a-b.test"),
        ("a-b.test", "A B", None, "DE", "n/a"), ("a-b.test", "A B", " ", "DE", None), ("ab.test", "A B", " ", "DE", "-"),
    ]
    k = [r[0] for r in spark.createDataFrame(rows, "domain string, name string, city string, country string, email string").select(ledger.lead_key()).collect()]
    assert k[0] == k[1] and k[0] != k[2] and k[3] == k[4] and k[4] != k[5]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 200):
        ids = rng.integers(0, 3, n)
        assert leakage.suffix_array(ids).tolist() == sorted(range(n), key=lambda i: ids[i:].tolist())


def test_leaks_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 40)))) for i in range(12)] + [(99, "one two"), (100, None)]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab + ["zz"]) for _ in range(40)]
        for _ in range(2):
            src = (rng.choice(items[:12])[1]).split()
            k = rng.randrange(len(src))
            w[10:10] = src[k : k + rng.randrange(4, 20)]
        docs.append((d, "<p>" + " ".join(x.upper() if rng.random() < 0.2 else x + rng.choice(["", ",", "<br>"]) for x in w) + "</p>"))
    docs += [(900, None), (901, ""), (902, items[0][1]), (902, items[0][1])]
    want = set()
    for d, t in docs:
        dw = text.words(t)
        grams = defaultdict(set)
        for k in range(len(dw) - 7):
            grams[tuple(dw[k : k + 8])].add(k)
        for i, x in items:
            iw = text.words(x)
            c = {p for k in range(len(iw) - 7) if tuple(iw[k : k + 8]) in grams for p in range(k, k + 8)}
            if iw and len(c) / len(iw) >= 1 / 3 - 1e-12 and c:
                want.add((d, i))
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_items=5)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


def test_words():
    assert text.words("Nach Re<b>gel</b> 18&nbsp;der<br>Ordnung PrÃ¼ferin so​ft") == ["nach", "regel", "18", "der", "ordnung", "prüferin", "soft"]
    assert text.words(None) == [] and text.words("a < b and c > d")[:2] == ["a", "b"]


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, rng.choices(["a", "b", "c", None, "x"], [60, 30, 5, 3, 2])[0], "word " * rng.randrange(0, 60)) for i in range(1500)]
    targets = [("a", 0.3, 1), ("b", 0.4, 2), ("c", 0.2, 5), ("d", 0.1, 3)]
    sized = mixture.sizes(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    plan = mixture.plan(sized, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    mixed = mixture.mix(sized, plan, slice_rows=7)
    uses = Counter((r.source, r.doc_id) for r in mixed.collect())
    caps = {s: m for s, _, m in targets}
    assert all(n <= caps[s] for (s, _), n in uses.items())
    report = {r.source: r for r in mixture.shares(mixed, plan).collect()}
    for s, share, _ in targets[:3]:
        assert abs(report[s].reached_share - share / 0.9) < 0.02
    assert report["d"].reached_share == 0
    # systematic sampling: copies of a source's documents differ by one at most
    for s in "abc":
        n = [uses.get((s, i), 0) for i, src, t in docs if src == s and t]
        assert max(n) - min(n) <= 1


def test_tokens_of_whole_texts(spark):
    texts = [None, "", "Hello world", "a" * 3000, "so " * 150_000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixture.token_count(F.col("t"))).collect()]
    assert got[:3] == [0, 0, 2] and got[4] == 150_001


def test_block_max_search_is_exact():
    rng = random.Random(6)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)]
    examples = [tuple(rng.choice(vocab) for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    df = Counter(t for w in examples for t in set(w))
    index = safety.Index(examples, lambda t: math.log(1 + 1500 / (1 + df.get(t, 0))))
    forward = [index.weights(w) for w in examples]
    for n in range(200):
        query = index.weights(tuple(rng.choice([*vocab, "unseen"]) for _ in range(rng.randrange(1, 10))))
        radius, k = rng.choice([0.0, 0.3, 0.6]), rng.choice([1, 5, 12])
        scores = sorted(((-sum(x * v.get(t, 0.0) for t, x in query.items()), i) for i, v in enumerate(forward)))
        want = [-x for x, _ in scores[:k] if -x >= radius and x < 0]
        got = [x for x, _ in index.nearest(query, k, radius) if x > 0]
        assert np.allclose(got, want), n


@pytest.mark.parametrize("matrix", [0, safety.MATRIX])
def test_skipped_searches_change_no_share(matrix, monkeypatch):
    monkeypatch.setattr(safety, "MATRIX", matrix)
    rng = random.Random(13)
    vocab = [f"t{int(rng.paretovariate(0.8))}" for _ in range(60)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    examples = {text(rng.randrange(2, 9)): rng.choice([[0, 0, 0, 0], [0, 0, 0, 1], [0.9, 0, 0, 9.1], [0.2, 0, 0, 0], [0, 0.05, 1, 0], [0, 3, 0, 1]]) for _ in range(700)}
    # of the nearest example less than a tenth are votes for the kind, with those of the next it is more
    examples |= {"p q r s t u v w x": [0.9, 0, 0, 9.1], "p q r s t u v w y": [0.6, 0, 0, 0]}
    frequency = Counter(t for p in examples for t in set(p.split(" ")))
    model = safety.Model(examples, frequency, len(examples))
    assert (model.all.matrix is None) == (matrix == 0)
    searched, found, search = Counter(), 0, model.all.nearest

    def counted(query, k, *radius):
        searched[k] += 1
        return search(query, k, *radius)

    model.all.nearest = counted
    weights = [model.all.weights(tuple(p.split(" "))) for p in model.texts]
    for p in [*(text(rng.randrange(1, 10)) for _ in range(500)), "p q r s t u v w x"]:
        query = model.all.weights(tuple(p.split(" ")))
        near = sorted((-sum(x * w.get(t, 0.0) for t, x in query.items()), i) for i, w in enumerate(weights))[: model.k]
        got, total, best = np.zeros(3), 0.0, 0.0
        for c, i in near:
            v, c = model.votes[i], -c
            if c >= safety.LEAST_COSINE and v.sum() > 0:
                best = best or c
                got += (c / best) ** 4 * c * c * v[:-1]
                total += (c / best) ** 4 * c * c * v.sum()
        want = got / (total + safety.PRIOR)
        want[want < safety.LEAST_SHARE] = 0
        # equal cosines may change places among the last of the nearest
        ties = len({round(c, 9) for c, _ in near}) < len(near)
        assert ties or np.allclose(model.judge(p)[0], want), p
        found += want.any() and not ties
    assert found and model.judge("p q r s t u v w x")[0][0] > 0.1
    # a faint vote far away can't reach a share that counts: nothing else is searched
    faint = safety.Model({"a b c d e f": [0.1, 0, 0, 0], "g h i j k l": [0, 0, 0, 1]}, {}, 9)
    faint.all.nearest = None
    assert faint.judge("a b c x y z")[0] == (0.0, 0.0, 0.0)


def test_repeated_work_is_done_once(monkeypatch):
    rng = random.Random(17)
    vocab = [f"t{int(rng.paretovariate(0.8))}" for _ in range(80)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    examples = {text(rng.randrange(2, 9)): rng.choice([[0, 0, 0, 1], [1, 0, 0, 0], [0, 0.5, 1, 0]]) for _ in range(500)}
    frequency = Counter(t for p in examples for t in set(p.split(" ")))
    queries = [text(rng.randrange(1, 10)) for _ in range(200)]
    model, searched = safety.Model(examples, frequency, len(examples)), Counter()
    plain = [model.all.nearest(model.all.weights(tuple(p.split(" "))), k) for p in queries for k in (1, 12)]
    # adding up all at once finds what the lists' blocks find
    monkeypatch.setattr(safety, "PLAIN", 0)
    blocks = [model.all.nearest(model.all.weights(tuple(p.split(" "))), k) for p in queries for k in (1, 12)]
    assert all(np.allclose([c for c, _ in x], [c for c, _ in y]) for x, y in zip(plain, blocks, strict=True))
    search = model.all.nearest
    model.all.nearest = lambda q, k, *radius: searched.update([k]) or search(q, k, *radius)
    # neighbours are the same whosever votes are left out
    p = next(p for p in model.texts if examples[p] == [1, 0, 0, 0])
    one, two = model.judge(p, np.zeros(4)), model.judge(p, np.array([0.5, 0, 0, 0]))
    assert searched[model.k] == 1 and one != two
    # other votes, the same index
    assert safety.Model({p: [1, 0, 0, 0] for p in examples}, frequency, len(examples), before=model).all is model.all
    assert safety.Model(examples, frequency, len(examples) + 1, before=model).all is not model.all
    # rough cosines show that a faint vote far away can't count: nothing is searched
    faint = safety.Model({"a b c d e f": [0.1, 0, 0, 0], "g h i j k l": [0, 0, 0, 1]}, {}, 9)
    faint.some.nearest = faint.all.nearest = None
    assert faint.judge("a b c x y z")[0] == (0.0, 0.0, 0.0)
    # a line that many documents hold is folded once, markup over several lines is seen as before
    folded, seen = safety.folded, Counter()
    monkeypatch.setattr(safety, "folded", lambda t: seen.update([t]) or folded(t))
    assert safety.passages("Only here ö. &lt;a. href=x&gt;\nOnly here ö.") == [("only", "here", "ö")] * 2
    assert seen["Only here ö."] == 1


def test_rows_are_cut_without_repeated_work(spark):
    # a mail address at the row's site asks for that host once; what can't be a provider's slip isn't compared with any
    parser = known.Parser(["gmail.com", "gmx.de"])
    assert parser.parse("a.b@mueller-steuer.de", "www.mueller-steuer.de") == ("a.b@mueller-steuer.de", "h", "mueller-steuer", "mueller-steuer.de")
    assert (parser.parts.cache_info().misses, parser.parts.cache_info().hits) == (1, 1)
    assert parser.parse("a@gmial.com", "x.gmx.de") == ("a@gmial.com", "p", "a", None)
    assert parser.parse("x.com/@a", "a+tag@b.co") == ("a@b.co", "h", "b", "x.com")
    assert [parser.site(h) for h in ("", "gmx.de", "a.gmx.de", "a.b.co.uk")] == [None, None, None, "b.co.uk"]
    # words are told by texts made once a row: no filter splits them again
    rows = [("mueller steuer", "mueller", "mueller info", 0), ("maier steuer", "", "maier info", 0), ("", "", "", 0)] * 3
    x = spark.createDataFrame(rows, "names string, sites string, mails string, canon long")
    assert firms.sides(x, least=2) == (frozenset(), {"mueller": 6, "maier": 6, "steuer": 6, "info": 6}, 9)
    plans, table = [], type(x).collect
    type(x).collect = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or table(df)
    try:
        firms.sides(x, least=2)
    finally:
        type(x).collect = table
    assert plans and not any("size(array_distinct" in p for p in plans)


def test_labels_are_believed_as_far_as_others_bear_them_out():
    own = np.array([1.0, 0.0, 0.0, 0.0])
    # the second passage explains the label; the others vote for none
    got = safety.explained(own, [(0.1, 0, 0), (0.9, 0, 0), (0.3, 0, 0)], (0.4, 0.4, 0.4))
    assert [v.tolist() for v in got] == [[0, 0, 0, 1], [1, 0, 0, 0], [0, 0, 0, 1]]
    # nothing explains it: all passages carry as much as such labels deserve
    assert [v.tolist() for v in safety.explained(own, [(0.1, 0, 0), (0, 0, 0)], (0.4, 0.4, 0.4))] == [[0.4, 0, 0, 0]] * 2
    rng = np.random.default_rng(3)
    share = rng.uniform(0.01, 0.99, 3000)
    a, b = safety.fit_curve(share, (rng.uniform(size=3000) < 1 / (1 + np.exp(-(1 + 2 * np.log(share / (1 - share)))))).astype(float))
    assert abs(a - 1) < 0.3 and abs(b - 2) < 0.4
    assert safety.fit_curve(np.array([]), np.array([])) == (0.0, 1.0)
    assert safety.fit_curve(np.full(500, 0.9), np.ones(500))[1] > 0


def test_passages_undo_disguises():
    flat = {w for p in safety.passages("You a.s.s.h.o.l.e! 1d10t f u c k y 0 u, as​shole fuuuuck 53k5 2nd floor") for w in p}
    assert {"asshole", "idiot", "fuck", "seks"} <= flat
    assert safety.passages(None) == [] and safety.passages("...") == []


def test_scores_find_what_the_labels_show(spark):
    bad = ["you are a complete {} and everybody knows", "get lost you {} or else", "what a {} go away now please"]
    good = ["we file your tax return before the date", "call us for a fixed fee and a short plan", "our office opens at nine and closes at five", "bring the papers in a shoe box that is fine"]
    words = ["moron", "fool", "idiot", "clown"]
    rng = random.Random(7)
    docs, labels, truth = [], [], {}
    for i in range(240):
        s = [rng.choice(good) for _ in range(4)]
        truth[i] = i % 4 == 0
        if truth[i]:
            s.insert(2, rng.choice(bad).format(rng.choice(words)))
        docs.append((i, "s", ". ".join(s) + "."))
        if i < 120:
            labels.append((i, 1, "Abuse " if truth[i] else "none", None))
    labels += [(3, 2, None, None), (5, 2, "??", None), (None, 1, "abuse", None)]
    got = safety.score(spark.createDataFrame(docs, "doc_id long, source string, text string"), spark.createDataFrame(labels, "doc_id long, rater int, kind string, rated_at timestamp"))
    found = {r.doc_id for r in got.filter(f"kind = 'abuse' and score >= {safety.THRESHOLD}").collect()}
    assert found == {i for i, t in truth.items() if t}
    assert got.filter("kind <> 'abuse' and score >= 0.5").count() == 0


def one_slip(rng, w, letters="abcdefghiklmnoprstuvz"):
    k = rng.randrange(len(w))
    return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :], w[: max(0, k - 1)] + w[k : k + 1] + w[max(0, k - 1) : k] + w[k + 1 :]])


def test_one_slip_on_each_side_leaves_a_common_key():
    rng = random.Random(11)
    word = lambda low, high: "".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(rng.randrange(low, high)))
    for k in range(4000):
        w = [word(2, 12) for _ in range(k % 4 or 1)]
        if k % 8 == 4:
            w = [word(12, 60)]
        a, b = list(w), list(w)
        i, j = rng.randrange(len(w)), rng.randrange(len(w))
        a[i], b[j] = one_slip(rng, a[i]), one_slip(rng, b[j])
        # words that the slips left as they are may be established, or all may be, or none
        whole = [x for n, x in enumerate(w) if k % 3 and (k % 3 == 2 or rng.random() < 0.7)]
        known_words = Spelling({x: 50 for x in whole if k % 3 == 2 or x not in (a[i], b[j], w[i], w[j])})
        a, b = "-".join(a) + ".test", "-".join(b) + ".test"
        keys = lambda t: set(known.band_keys("h", t, known_words)[0])
        assert keys(a) & keys(b), (a, b, w)
        assert keys(a) & keys("-".join(w) + ".test"), (a, w)


def test_spelling():
    sp = Spelling({"krakervin": 100, "krakervim": 20, "tastoltorm": 90, "tax": 50, "lorvel": 9, "lorvek": 8})
    assert sp.sound("krakervin") and not sp.sound("krakervim") and sp.options("krakervim") == ("krakervin",)
    assert sp.options("rkakervin") == ("krakervin",) and sp.options("txa") == ("tax",) and sp.options("zzzzz") == ()
    assert sp.sound("krakervintastoltorm") and sp.options("krakervintastotlorm") == ("krakervintastoltorm",) and sp.options("krakervitnastoltorm") == ("krakervintastoltorm",)
    # as many times more, a misspelling stays one
    many = Spelling({"krakervin": 100_000, "krakervim": 20_000, "lorvel": 9000, "lorvek": 8000})
    assert many.options("krakervim") == ("krakervin",) and many.sound("lorvek") and many.sound("lorvel")


def test_registered_hosts():
    for host, site, label in [("a.firm-a.co.uk", "firm-a.co.uk", "firm-a"), ("firm-b.com.tr", "firm-b.com.tr", "firm-b"), ("www.x.de", "x.de", "x"), ("co.uk", "co.uk", "co"), ("localhost", "localhost", "localhost"), ("mail.co.test", "co.test", "co")]:
        assert known.registered(host) == site and known.name_label(host) == label
    p = known.Parser(["mail.test"])
    assert p.parse("Info+x@Firm-A.co.uk", "https://shop.firm-b.com.tr/x?y") == ("info@firm-a.co.uk", "h", "firm-a", "firm-b.com.tr")
    assert p.parse("none", "NONE") == (None, None, None, None) and p.parse(None, "mial.test")[3] is None


def test_a_slip_on_each_side_is_known(spark):
    leads = [(1, 1, "info@krakervins-tastoltorm.test", None), (2, 2, "info@krakervin-tastoltorms.test", None), (3, 2, None, "www.skernsmarvobis.test"), (4, 2, "info@krakervin-tastoltorn7.test", None)]
    leads = spark.createDataFrame(leads, "seq long, batch_no int, email string, domain string")
    sent = spark.createDataFrame([("info@rkakervin-tastoltorm.test",)], "email string")
    campaign = spark.createDataFrame([("skernasmarvobsi.test",)], "site string")
    got = {tuple(r) for r in known.known_leads(leads, sent, campaign, ["mail.test"]).collect()}
    assert got == {(1, "sent_log"), (2, "sent_log"), (2, "leads"), (3, "firmalar")}


def test_slips():
    assert known.slips("office1@a.test", "office2@a.test") == 99
    assert known.slips("x.y@a.test", "x_y@a.test") == 99
    assert known.slips("ofice@a.test", "offcie@a.test") == 2
    assert known.slips("hello@a-b.test", "info@a-b.test") == 99


def entries(spark, rows):
    return spark.createDataFrame([("m", t, "leads", b) for t, b in rows], "kind string, text string, origin string, since int")


def test_index_opens_again_and_reads_what_it_must(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh") for _ in range(7)) + "-" + "".join(rng.choice("klmnoprs") for _ in range(7)) + ".test" for _ in range(60)]
    texts = base + [w[:3] + w[4:] for w in base[:20]]
    first = known.BandIndex(spark, counts={"abcdefg": 9})
    first.append(first.keys(entries(spark, [(t, k) for k, t in enumerate(texts)])))
    again = known.BandIndex(spark, first.path)
    assert again.sent.value == {"abcdefg": 9} and again.buckets == first.buckets and again.read().count() == first.read().count() > 80
    probe = again.keys(entries(spark, [(w, 99) for w in base[:20]]))
    got = {(r.text, r.since) for r in again.hits(probe, again.matching(probe)).collect()}
    assert got == {(w, k) for k, w in enumerate(base[:20])}
    # a step whose state file is missing doesn't count
    probe.limit(1).withColumn("bucket", again.bucket()).write.partitionBy("bucket").parquet(f"{first.path}/step=77")
    assert known.BandIndex(spark, first.path).read().count() == first.read().count()
    # one probe reads the partitions of its keys only
    files = lambda df: {f.split("bucket=")[1].split("/")[0] for f in df.inputFiles()}
    one = again.keys(entries(spark, [(base[30], 99)]))
    n = {str(r[0]) for r in one.select(again.bucket()).distinct().collect()}
    assert len(n) < again.buckets and files(again.read([int(x) for x in n])) <= n | files(again.read())


def test_batches_one_by_one_equal_all_at_once(spark, small):
    t = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    run = lambda n: sorted(map(tuple, known.known_leads(t("leads"), t("sent_log"), t("firmalar"), known.provider_hosts(t("mail_providers")), rounds=n).collect()))
    assert run(1) == run(4)


def test_similar_words_are_all_found(spark):
    rng = random.Random(10)
    vocab = {"".join(rng.choice("abcdeg") for _ in range(rng.randrange(4, 9))): rng.choice([1, 2, 9, 40, 900]) for _ in range(400)}
    df = spark.createDataFrame(list(vocab.items()), "w string, n long")
    got = {(r.w, r.v) for r in variants.similar_words(df).collect()}
    want = {(w, v) for w in vocab for v in vocab if w != v and vocab[v] >= RATIO * (vocab[w] - FEW) and (vocab[v] > vocab[w] or (vocab[v] == vocab[w] and v < w)) and damerau(w, v) <= 1}
    assert got == want and want


def test_name_readings():
    assert firms.name_words("TastoltormKrakervin Auditors") == ["tastoltorm", "krakervin", "auditors"]
    assert firms.name_words("Garvötilk & Lörvel") == ["garvotilk", "lorvel"]
    assert firms.near_sets(("abcdef", "ghijkl"), ("abcdef", "ghijkx")) and not firms.near_sets(("abcdef", "ghijkl"), ("abcdef", "uvwxyz"))
    assert firms.near_sets(("abcdefghijkl",), ("abcdef", "ghijkl")) and firms.near_sets(("abcdefghijkl", "nord"), ("abcdef", "ghijkl", "nord"))
    assert not firms.near_sets(("abcdef", "ghijkl"), ("abcdef", "ghijkl", "nord"))
    w = {"rare": 8.0, "ltd": 0.5}
    assert variants.soft_similarity(["rare", "ltd"], ["rare"], w) > variants.soft_similarity(["ltd", "rare"], ["ltd"], w)
    assert variants.soft_similarity([], [], w) == 0


def test_readings():
    r = firms.Reader(frozenset({"tax", "gmbh"}), Spelling({"krakervin": 50, "tastoltorm": 60, "lorvel": 40}))
    assert r.read("krakervin tastoltorm tax gmbh", "krakervintastoltorm", "") == (("krakervin", "tastoltorm"), [])
    assert r.fixed(("krakervim", "tastoltorm")) == ["krakervin tastoltorm"] and r.fixed(("krakervin", "tastoltorm")) is None
    assert r.fixed(("krakervintastotlorm",)) == ["krakervin tastoltorm"] and r.cuts(("krakervintastotlorm",)) == ["krakervin tastotlorm"]
    # a short word alone counts if two columns say it, and words with digits are words
    assert r.read("siemens gmbh", "siemens", "")[0] == ("siemens",) and r.read("siemens gmbh", "", "")[0] == ()
    assert r.read("4you gmbh", "4you", "")[0] == ("4you",) and firms.name_words("3M Deutschland 24") == ["3m", "deutschland"]
    assert firms.Words([]).of("4you GmbH", "office2@4you.co.uk", "www.shop.4you.co.uk")[:5] == ("4you gmbh", "4you", "4you", "office2@4you.co.uk", "4you.co.uk")


def test_equal_columns_are_read_once():
    r, calls = firms.Reader(frozenset({"gmbh"}), Spelling({"krakervin": 50, "tastoltorm": 60})), []
    core = r.core
    r.core = lambda ws, against: calls.append(ws) or core(ws, against)
    got = r.read("krakervim tastoltorm gmbh", "krakervintastoltorm nord", "krakervintastoltorm nord")
    assert len(calls) == 2 and got == r.read("krakervim tastoltorm gmbh", "krakervintastoltorm nord", "nord krakervintastoltorm") and len(calls) == 5


def test_a_slip_leaves_a_common_term():
    rng = random.Random(8)
    letters = "abcdefghiklmnoprstuvz"
    none, some = firms.Reader(frozenset(), Spelling({})), None
    for _ in range(300):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in "ab")
        typo = one_slip(rng, a)
        if damerau(a, typo) > 1:
            continue
        x, y = tuple(sorted((a, b))), tuple(sorted((typo, b)))
        assert set(loose_terms(x)) & set(loose_terms(y)) and set(loose_terms((a + b,))) & set(loose_terms(x))
        assert set(reading_terms(none, x, [])) & set(reading_terms(none, y, []))
        some = firms.Reader(frozenset(), Spelling({a: 90, b: 80}))
        assert set(reading_terms(some, x, [])) & set(reading_terms(some, y, []))


def test_every_list_gives_candidates(spark):
    n = 3 * FULL + 5
    lists = {1: range(n), 2: range(FULL), 3: range(FULL, 2 * FULL + 1), 4: [7], 5: range(0, n, 50)}
    post = [(r, r % 4, t) for t, x in lists.items() for r in x] + [(0, 0, 1), (0, 0, 2)]
    other = [(r, 1000 + r % 40) for r in range(n)] + [(3, 77), (90, 77)]
    p, o = spark.createDataFrame(post, "rec long, src byte, term long"), spark.createDataFrame(other, "rec long, term long")
    rows = candidates(p, o).collect()
    got = {(r.a, r.b) for r in rows}
    assert len(got) == len(rows) and all(a < b for a, b in got)
    # lists up to FULL are read whole, longer ones by their other terms
    want = {(a, b) for t in (2, 5) for a in lists[t] for b in lists[t] if a < b}
    want |= {(a, b) for a in range(n) for b in range(a + 1, n) if a % 40 == b % 40} | {(3, 90)}
    assert want <= got
    # every record of a long list meets its two least ones of every table, which win a tie
    assert all({(least, r) for least in range(8) if least < r} <= got for r in range(n))
    assert len(got) < n * (FULL + 8 + n // 40 + 1)
    shares = defaultdict(set)
    for t, x in lists.items():
        for r in x:
            shares[r].add(t)
    assert all(r.same == any(t % 2 for t in shares[r.a] & shares[r.b] if t != 1) or shares[r.a] & shares[r.b] & {1, 3} for r in rows)
    assert candidates(p.limit(0), o).count() == 0


def test_long_lists_give_the_best_two_of_all_pairs(spark):
    """Records of one site or two, that share words, towns and countries in all combinations, against comparing all pairs."""
    from leadweave.llm import matching

    rng = random.Random(12)
    common, letters = ["tastoltorm", "krakervin", "lorvelbis"], "abcdefghiklmnoprstuvz"
    rows, post, n = [], [], 2 * FULL + 20
    for r in range(n):
        words = {one_slip(rng, w) if rng.random() < 0.2 else w for w in rng.sample(common, rng.randrange(1, 3))}
        words |= {"".join(rng.choice(letters) for _ in range(8))} if rng.random() < 0.6 else set()
        key = " ".join(sorted({"".join(sorted(words))} if rng.random() < 0.1 else words))
        for _ in range(rng.randrange(1, 4)):
            rows.append((r, r % 3, firms.hash_of(key), key, rng.choice([None, 11, 12, 13, rng.randrange(100, 150)]), rng.choice([None, 21, 22])))
        post += [(r, r % 3, 1)] + [(r, r % 3, 3)] * (r % 2) + [(r, r % 3, 4 + 2 * (r // 4))]
    x = spark.createDataFrame(rows, "rec long, src byte, k long, key string, town long, land long")
    p = spark.createDataFrame(post, "rec long, src byte, term long")
    further = x.select("rec", F.explode(F.array_compact(F.concat(F.transform(F.split("key", " "), lambda w: F.xxhash64(w)), F.array("town", F.bitwise_not("land"))))).alias("term")).distinct()
    total, strong = 5000, {"tastoltorm": 40, "krakervin": 300}
    of = {r: {t for q, _, t in post if q == r} for r in range(n)}
    size = Counter(t for s in of.values() for t in s)
    weight = {t: math.log(1 + (total - c + 0.5) / (c + 0.5)) for t, c in size.items()}
    pairs = [(a, b, sum(weight[t] for t in of[a] & of[b]), any(t % 2 for t in of[a] & of[b])) for a in range(n) for b in range(a + 1, n)]
    everything = spark.createDataFrame(pairs, "a long, b long, essential float, same boolean")

    def best(cand):
        got = defaultdict(list)
        for r in matching.scored(x, cand, strong, total).collect():
            got[r.q, r.src_d].append((-round(r.score, 3), r.d, r.exact))
        return {q: sorted(v)[:2] for q, v in got.items()}

    some = candidates(p, further, total, matching.documents(x))
    assert some.count() < len(pairs) and best(some) == best(everything)
    # terms beyond all combinations: the list is met as a whole
    matching.SUBSETS, kept = 1, matching.SUBSETS
    try:
        assert best(candidates(p, further, total, matching.documents(x))) == best(everything)
    finally:
        matching.SUBSETS = kept


def test_closed_matches_of_one_reading():
    from leadweave.llm.matching import PAIRS

    bit = {p: 1 << k for k, p in enumerate(PAIRS)}
    assert ROOTS[0] == [0, 1, 2, 3] and ROOTS[bit[0, 1] | bit[2, 3]] == [0, 0, 2, 2] and ROOTS[bit[1, 2] | bit[2, 3]] == [0, 1, 1, 1] and ROOTS[bit[0, 3] | bit[1, 2] | bit[2, 3]] == [0, 0, 0, 0]


def test_calibration_separates():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0.8, 0.1, (200, 2)), rng.normal(0.2, 0.1, (200, 2))])
    y = np.array([1.0] * 200 + [0.0] * 200)
    w = calibrate(x, y)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.99


def test_canon_word_is_writing_only():
    assert canon_word("Frau  Dr.") == canon_word("frau-dr") != canon_word("fraudrx")
