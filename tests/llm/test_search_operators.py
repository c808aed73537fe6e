"""Hard negatives, spelling variants and url verdicts against plain versions and on awkward tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import hard_negatives, host_reputation, spelling
from earshot.llm.queries import LLM_QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, rank int, n int, window int, score int"


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], VECTORS)


def mined(df, **options):
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()))


def drawn(kind, n=400, width=12, seed=1):
    random = np.random.default_rng(seed)
    vectors = random.standard_normal((n, width))
    if kind == "offset":
        vectors += 5
    elif kind == "clusters":
        vectors = vectors[random.integers(0, 4, n)] + 0.01 * vectors
    elif kind == "negative":
        vectors = np.abs(vectors) * np.where(np.arange(n) % 2, 1, -1)[:, None]
    elif kind == "copies":
        vectors[: n // 3] = vectors[0]
    elif kind == "small":
        vectors *= 1e-3
    labels = random.integers(0, 5, n) if kind != "one label" else np.zeros(n, int)
    labels[:3] = 77
    return [(i, vectors[i].tolist(), int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("kind", ["even", "offset", "clusters", "negative", "copies", "small", "one label"])
def test_hard_negatives_against_every_pair(spark, kind):
    rows = drawn(kind)
    got = mined(vector_table(spark, rows), sample_rows=50)
    assert got == brute.hard_negatives([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0)


@pytest.mark.parametrize("width", [1, 2, 40])
def test_hard_negatives_of_any_width_in_several_parts(spark, width):
    rows = drawn("even", 150, width)
    got = mined(vector_table(spark, rows), anchor_bytes=1000, sample_rows=1)
    assert got == brute.hard_negatives([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0)


def test_hard_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (10, [1.0, 0.1], 1), (10, [1.0, 0.1], 1), (3, [0.9, 0.3], 2), (3, [0.9, 0.3], 2)]
    bad = [(20, None, 1), (20, [1.0, None], 1), (20, [nan, 0.0], 1), (20, [inf, 0.0], 1), (20, [1.0, 0.0], None)]
    odd = [(None, [1.0, 0.0], 2), (30, [1.0], 1), (40, [], 1), (50, [1e200, 0.0], 2), (60, [0.0, 0.0], 1)]
    got = mined(vector_table(spark, good + bad + odd))
    assert got == brute.hard_negatives([(i, x, v) for i, v, x in [*good, odd[-1]]], lambda i: i % 10 == 0)
    for rows in ([], bad, good[:1]):
        assert mined(vector_table(spark, rows)) == []


def test_an_index_omits_what_cannot_reach_the_threshold():
    random = np.random.default_rng(3)
    vectors = np.floor(random.standard_normal((300, 64)) * 100 * 0.9 ** np.arange(64))
    asked = np.floor(random.standard_normal((20, 64)) * 100 * 0.9 ** np.arange(64))
    scores = asked @ vectors.T
    for quantile in (0.2, 0.9, 0.999):
        least = np.quantile(scores, quantile, axis=1)
        index = hard_negatives.Index(vectors, float(((least - 0.5) / np.linalg.norm(asked, axis=1)).min()))
        i, j, score = index.reach(asked, hard_negatives.rest_norms(asked), least, np.ones(scores.shape, bool))
        assert sorted(zip(i, j, score)) == [(a, b, scores[a, b]) for a, b in zip(*np.nonzero(scores >= least[:, None]))]
    assert sum(index.listed) < 0.6 * 300 * len(index.listed)


def test_spelling_variants_against_every_pair(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute.spelling_variants(brute.damaged_words([(r.doc_id, r.text) for r in docs.collect()]))
    got = LLM_QUERIES["op12_bloom_spelling_variants"](spark, FOLDER).collect()
    assert len(got) == len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(r.form for r in got)


WORDS = {
    "": 5, "a": 70, "b": 7, "ab": 2, "aab": 1, "aaab": 900, "é": 7, "ß": 1, "\u4e2d\u6587": 3, "\U0001f600": 8,
    "letter": 1000, "leter": 100, "ltter": 100, "lettter": 10, "letteer": 1, "lefter": 9, "x" * 70: 1, "x" * 71: 30,
    "x" * 63: 10, "x" * 64: 1, "x" * 65: 100, "long" * 4000: 2, "long" * 4000 + "s": 20, "tie": 50, "tin": 50, "tix": 5,
}


def test_spelling_variants_of_odd_words(spark):
    words = spark.createDataFrame([(w, n, 1, "x") for w, n in WORDS.items()] + [(None, 4, 1, "x")], "word string, n long, length int, form string")
    got = {r.word: tuple(r)[1:] for r in spelling.variants(words).collect()}
    assert got == brute.spelling_variants(WORDS)
    # Small shards and passes change nothing.
    kept = words.where("word is not null").select("word", "n")
    pairs = {tuple(sorted((r.word, r.other))) for r in spelling.near_words(kept, shard_words=2, broadcast_bytes=8).collect()}
    assert pairs == {(a, b) for a in WORDS for b in WORDS if a < b and brute.one_edit(a, b)}
    assert spelling.variants(words.limit(0)).count() == 0


def test_corpus_words_of_odd_documents(spark):
    rows = [(1, None), (2, ""), (None, "Letters LETTERS letters"), (3, "Ünïts ÀÉÎÕÜß× ÀÉÎÕÜß×"), (4, "a" * 100_000), (4, "a" * 100_000)]
    docs = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, h int")
    for damage in (0, 1, 2, 31):
        got = {r.word: r.n for r in spelling.corpus_words(docs, damage=damage).collect()}
        assert got == brute.damaged_words(rows, damage)


def test_filters_have_no_false_negatives_and_few_false_positives():
    words = [f"word{i:06d}" for i in range(20_000)]
    hashes = spelling.word_hashes(words, 10)
    filters = spelling.Filters({10: 1}, {(10, 0): spelling.build(hashes[:10_000])})
    hit = filters.may_have(hashes, 10)
    assert set(range(10_000)) <= set(hit.tolist()) and len(hit) < 10_200
    assert not len(filters.may_have(hashes, 9))


URLS = [
    (1, None), (2, ""), (3, "no scheme/x"), (4, "HTTP://User@Host.Example.NET:80/en/x?q#f"), (5, "http://net/"), (6, "http://net"),
    (7, "http://a.b.example.net/en/"), (8, "http://example.net/EN/"), (9, "http://notexample.com/de/1"), (10, "x://example.com/de/?u=://y"),
    (11, "http://1.2.3.4:80/fr/"), (12, "http://a.co.uk/"), (13, "http://b.a.co.uk./"), (14, "://org/fr/"), (15, "http://sub.org/fr/a#://z"),
    (16, "http://net?x=/"), (None, "http://example.net/en/"), (1, "http://x.y.org/" + "p" * 100_000), (17, "http:///nohost"),
]


def judged(spark, urls, outcomes, **options):
    pages = spark.createDataFrame([(i, u, "h", "v", 1.0) for i, u in urls], "page_id long, url string, host string, verdict string, mu double")
    found = spark.createDataFrame(outcomes, "page_id long, bad boolean")
    return host_reputation.judge_urls(pages, found, **options)


def test_rules_on_odd_urls(spark):
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    got = {}
    for r in judged(spark, URLS, [], rules=rules).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path[:20], r.rule, r.verdict))
    assert sum(map(len, got.values())) == len(URLS)
    assert got[4] == [("user@host.example.net:80", "/en/x", None, "allow")]
    assert got[5] == [("net", "/", "net/", "block")] and got[6] == [("net", "", None, "allow")]
    assert got[7] == [("a.b.example.net", "/en/", "example.net/en/", "allow")]
    assert got[8] == [("example.net", "/EN/", "net/", "block")]
    assert got[9] == [("notexample.com", "/de/1", None, "allow")]
    assert got[10] == [("example.com", "/de/", "example.com/de/", "block")]
    assert got[14] == [("org", "/fr/", "org/fr/", "allow")] and got[15] == [("sub.org", "/fr/a", "org/fr/", "allow")]
    assert got[2] == got[3] == [("", "", None, "allow")] and got[17] == [("", "/nohost", None, "allow")]
    assert judged(spark, [], []).count() == 0
    with pytest.raises(ValueError):
        host_reputation.rule_for(F.col("host"), F.col("path"), [("block", "nothing")])


def test_domains_and_suffixes(spark):
    want = {
        "www.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "": ("", ""),
        "b.a.co.uk.": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "u@x.y.de:80": ("y.de", "de"), "1.2.3.4:80": ("1.2.3.4:80", ""),
        "[::1]": ("[::1]", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = host_reputation.domain_and_suffix(F.col("host"))
    assert {r.host: (r.d, r.s) for r in hosts.select("host", domain.alias("d"), suffix.alias("s")).collect()} == want


@pytest.mark.parametrize("differ", [False, True])
def test_reputation_shrinks_hosts_towards_their_domain(spark, differ):
    """Hosts with few outcomes or none follow their domain as far as the hosts of a domain are alike."""
    urls, outcomes = [], []

    def host(name, pages, bad):
        for k in range(pages):
            urls.append((len(urls), f"http://{name}/{k}"))
            outcomes.append((len(urls) - 1, k < bad))

    for k in range(20):
        host(f"h{k}.good.com", 20, k % 3)
        host(f"h{k}.evil.com", 20, 19)
    if differ:
        host("spam.good.com", 200, 190)
    host("new.good.com", 1, 1)
    host("new.evil.com", 1, 0)
    urls.append((len(urls), "http://unseen.evil.com/"))
    urls.append((len(urls), "http://unseen.good.com/"))
    got = {r.host: r.verdict for r in judged(spark, urls, outcomes).collect()}
    few = {"spam.good.com"} if differ else {"unseen.evil.com", "new.evil.com"}
    assert {h for h, v in got.items() if v == "block"} == {f"h{k}.evil.com" for k in range(20)} | few
    # A page with several outcomes is bad if one is; unlabelled pages and outcomes of other pages say nothing.
    more = [(0, True), (0, False), (1, None), (99_999, True)]
    rows = host_reputation.reputations(
        spark.createDataFrame(urls[:2], "page_id long, url string"), spark.createDataFrame(more, "page_id long, bad boolean")
    )
    assert [(r.labelled, r.bad) for r in rows.collect()] == [(1, 1)]


def test_reputation_does_not_depend_on_the_way_hosts_are_looked_up(spark, monkeypatch):
    urls = [(i, f"http://h{i % 7 if i % 3 else 0}.d{i % 4}.com/{i}") for i in range(300)]
    outcomes = [(i, i % 7 == 0) for i in range(0, 300, 2)]

    def rows():
        # Sums of doubles depend on the order in their last digits.
        return sorted((r.page_id, r.verdict, round(r.host_bound, 9)) for r in judged(spark, urls, outcomes).collect())

    want, plain = rows(), host_reputation.lookup_join
    monkeypatch.setattr(host_reputation, "lookup_join", lambda *a, **k: plain(*a, **k, limit=0, hot_share=0.05))
    assert rows() == want
