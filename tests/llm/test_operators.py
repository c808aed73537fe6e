"""Operators against plain versions and on awkward tables."""

import hashlib
import json
import math
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import chat, common, fertility, itq, language_id, licenses, line_dedup, mixing, order_minhash, packing, warc
from earshot.llm.queries import LLM_QUERIES
from tests.frames import plan_of
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
LONG = "long " * 30_000
ODD = [
    (1, None, "en", "s", 0),
    (2, "", None, None, 0),
    (3, " \t\n ", "en", "s", 0),
    (4, LONG, "en", "s", 0),
    (4, LONG, "en", "s", 0),
    (5, LONG, None, "t", 0),
    (None, "a text without id that is long enough to count", "de", "s", 0),
    (6, "A text without ID that is long enough to count", "de", "s", None),
    (7, "a text without id that is long enough to count", "de", "t", 1),
    (8, "7 + 7", "en", "t", 1),
]
EXTRA = ", unit int, side int, rep int, n long, bucket string, key string, part int, tokens int, epoch int, drops int, band int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, *[0] * 3, 5, "x", "x", *[0] * 5) for r in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA
    return spark.createDataFrame(rows, schema)


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda x: (x is None, x))


PER_DOCUMENT = {
    "line_dedup": line_dedup.dedup_lines,
    "fertility": fertility.quality,
    "licenses": licenses.scan,
    "order_minhash": order_minhash.duplicate_classes,
    "language_id": language_id.identify,
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_a_row_for_each_document_also_of_odd_and_empty_tables(odd, name):
    assert ids(PER_DOCUMENT[name](odd)) == ids(odd)
    assert PER_DOCUMENT[name](odd.limit(0)).count() == 0


def test_other_operators_on_empty_tables(spark, odd):
    none = odd.limit(0)
    assert packing.pack(none).count() == mixing.mix(none, max_repeats=2.0).count() == 0
    assert chat.format_chats(spark.read.parquet(f"{FOLDER}/conversations.parquet").limit(0)).count() == 0
    assert warc.archive_pages(spark.read.parquet(f"{FOLDER}/pages.parquet").limit(0)).count() == 0
    assert itq.near_vectors(spark.read.parquet(f"{FOLDER}/embeddings.parquet").limit(0)).count() == 0


def check_pieces(pieces, docs, window=2048):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    want = {}
    for row in docs:
        coded = plain.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        want.setdefault(row["doc_id"], []).append(coded)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(by_doc) == set(want)
    for doc, coded in want.items():
        assert sum(p["length"] for p in by_doc[doc]) == sum(map(len, coded))
        if len(coded) == 1:
            at = 0
            for p in sorted(by_doc[doc], key=lambda p: p["start"]):
                cut = np.array(coded[0][at : at + p["length"]], "<u4").tobytes()
                assert (p["start"], p["ids_crc32"], p["doc_tokens"]) == (at, zlib.crc32(cut), len(coded[0]))
                at += p["length"]
    ends = {}
    for sequence, spans in by_sequence.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        ends[sequence] = at
    assert all(ends[s] == window for s in range(len(ends) - 1)) and ends[len(ends) - 1] <= window


def test_packing(spark, odd):
    for docs in (documents(spark).limit(60), odd):
        rows = docs.select("doc_id", "text").collect()
        check_pieces(packing.pieces_digest(packing.pack(docs)).collect(), rows)


@pytest.mark.parametrize("weights", [{"a": 3, "b": 1, "c": 1}, {"a": 1, "b": 0}, {}])
def test_packing_to_weights_is_a_plain_deficit_round_robin(spark, weights):
    rows = [(i, "abbc"[i % 4], f"text {i} " * (i % 9)) for i in range(60)] + [(99, None, "no source " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    encode = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode_ordinary
    left = {}
    for _, source, text in rows:
        left[source] = left.get(source, 0) + len(encode(text)) + 1
    queues, _, quantum = packing.quanta(left, 64, weights)
    deficit, stream = dict.fromkeys(queues, 0), []
    while any(left.values()):
        for queue, q in zip(queues, quantum.tolist()):
            deficit[queue] += q
            send = min(deficit[queue] // packing.GRAIN, left[queue])
            deficit[queue] -= send * packing.GRAIN
            left[queue] -= send
            stream += [queue] * send
    got = [None] * len(stream)
    for p in packing.pack(docs, 64, weights=weights).collect():
        at = p.sequence_id * 64 + p.offset
        got[at : at + p.length] = [p.source] * p.length
    assert got == stream


def test_a_source_of_no_weight_may_be_of_any_length():
    for long in (3 * 10**9, 10**13):
        _, length, quantum = packing.quanta({"a": 10, "b": long}, 2048, {"a": 1, "b": 0})
        assert all(int(n) * packing.GRAIN // int(q) * int(quantum.max()) < 2**63 for n, q in zip(length, quantum))


def test_line_dedup_against_plain(spark, odd):
    docs = odd.select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(line_dedup.BLANKS))
    held = {}
    for doc, text in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 20 and doc is not None:
                held.setdefault(key(line), set()).add(doc)
    want = []
    for doc, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == doc]
        want.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [tuple(r) for r in line_dedup.lines_digest(line_dedup.dedup_lines(docs)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[2] for r in got)


def test_chats_are_read_back(spark):
    said = ["", None, "\\", "<|", "\\0<|end|>\\1", "<<||>|", "<|turn|>\n", "é🙂"]
    rows = [(1, i, role, t) for i, (t, role) in enumerate(zip(said * 2, ["user", "assistant", "assistant", None] * 4))]
    rows += [(2, None, "<|role|>", "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (None, 1, "user", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.chats_digest(chat.format_chats(turns)).collect()}
    for conv in (1, 2, None):
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        own = [(r, x) for *_, r, x in sorted(own)]
        loss = "".join(x for r, x in own if r == "assistant")
        text = "".join(f"{r}\n{x}\n" for r, x in own)
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)


def test_chats_stay_in_spark_expressions(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    plan = chat.chats_digest(chat.format_chats(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("target", [{"max_repeats": 3.0}, {"entropy": 2.5}])
def test_exponent_meets_its_target(spark, target):
    share = np.array([0.6, 0.2, 0.1, 0.06, 0.04])
    a = mixing.find_exponent(spark.createDataFrame([(x,) for x in share.tolist()], "share double"), **target)
    if "max_repeats" in target:
        assert (share[-1] / share[0]) ** (a - 1) == pytest.approx(3.0, rel=1e-6)
    else:
        w = share**a / (share**a).sum()
        assert (0 <= a <= 1) and (a in (0, 1) or -(w * np.log2(w)).sum() == pytest.approx(2.5, abs=1e-6) or a == 1)


def test_mixture_reads_all_and_repeats_within_limits(spark, odd):
    for docs in (documents(spark), odd):
        mixed = mixing.mix(docs, max_repeats=2.0).collect()
        n = {}
        for r in docs.collect():
            n[(r["doc_id"], r["source"])] = n.get((r["doc_id"], r["source"]), 0) + 1
        drawn = {}
        for r in mixed:
            drawn[(r["doc_id"], r["source"])] = drawn.get((r["doc_id"], r["source"]), 0) + 1
        assert set(drawn) == set(n)
        assert all(n[k] <= drawn[k] <= 2 * n[k] for k in n)
        assert all(0 <= r["place"] < 1 for r in mixed)
    total = {}
    for r in mixing.mix(documents(spark), entropy=0.0, budget=20_000).collect():
        total[r["source"]] = total.get(r["source"], 0) + r["tokens"]
    assert 20_000 <= sum(total.values()) < 20_000 + 20 * 10_000


def plain_texts(n, size, seed=0):
    """Texts of common words, each with a share of long words of its own."""
    random = np.random.default_rng(seed)
    short = "the of and to in is it for on was as at by he be we or an are this but not you all had".split()
    long = "people children government development information different important university experience community".split()
    share = np.linspace(0.15, 0.45, n)
    return [" ".join(str(random.choice(long if random.random() < p else short)) for _ in range(size)) for p in share]


def garbled(size, seed=1):
    random = np.random.default_rng(seed)
    return " ".join("".join(random.choice(list("qxzjkvwy0987"), 8)) for _ in range(size))


def verdicts(spark, rows):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    return [r.kept for r in fertility.quality(docs).orderBy("doc_id").select("kept").collect()]


def test_texts_of_rare_lengths_and_languages_are_judged(spark):
    rows = [(t, "en") for t in plain_texts(40, 200)]
    rows += [(plain_texts(3, 4000)[1], "en"), (plain_texts(3, 70)[1], "en"), (plain_texts(3, 200)[1], "xx"), (plain_texts(3, 200)[1], None)]
    rows += [(garbled(4000), "en"), (garbled(70), "en"), (garbled(200), "xx"), (garbled(200), None)]
    assert verdicts(spark, rows) == [True] * 44 + [False] * 4


def test_copies_count_once_in_the_bands(spark):
    plain = [(t, "en") for t in plain_texts(40, 200)]
    assert verdicts(spark, plain + [plain[-1]] * 200) == [True] * 240
    assert verdicts(spark, plain + [(garbled(90), "en")] * 200) == [True] * 40 + [False] * 200


def test_license_scan_on_planted_notices(spark):
    apache = " ".join(licenses.TEMPLATES[3][1].split())
    wrapped = "\n".join(apache[i : i + 60] for i in range(0, len(apache), 60))
    rows = [(1, "Foo.\nReleased under the MIT License."), (2, None), (3, wrapped), (4, "the license of the version"), (5, "Under CC BY-NC 4.0")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "", "apache-2", "", "cc-by-nc"]
    assert (got[1].first_word, got[1].n_base, got[2].n_words, got[2].first_word) == (2, 1, 0, None)


def test_licenses_are_told_apart_by_what_names_them(spark):
    cc = "Licensed under a Creative Commons Attribution{} 4.0 International License"
    gnu = "This work is licensed under the GNU {}General Public License version {}"
    far = "Released " + "word " * 50 + "under the " + "word " * 50 + "MIT or any license"
    notices = {
        "Released under the Apache License": "", "Released under the GPL License": "", "Released under the BSD License": "",
        "Licensed under CC BY 4.0": "", "Licensed under CC BY-SA 4.0": "", "Licensed under CC BY-NC 4.0": "cc-by-nc",
        cc.format(""): "", cc.format("-NonCommercial"): "cc-by-nc", cc.format("-ShareAlike"): "cc-by-sa",
        gnu.format("", 2): "", gnu.format("", 3): "gpl-3", gnu.format("Lesser ", 3): "", gnu.format("Affero ", 3): "",
        "Licensed under the Apache License 2.0": "apache-2", "Released under the MIT License": "mit", far: "",
        "word " * 500 + gnu.format("", 3) + " word" * 500: "gpl-3",
    }
    notices |= {text: label for label, text in licenses.TEMPLATES}
    rows = list(enumerate(notices))
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {text: got[i] for i, text in rows} == notices


def test_pages_come_back_from_archives(spark):
    rows = [(1, "u", "x"), (2, None, "x"), (3, "u\n", None), (4, "v", ""), (None, "w", "x"), (5, "z", "é" * 10), (2, "q", "x")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    for least in (0, 2):
        got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_pages(pages, least).collect()), key=repr)
        top = {"x": 2, "": 4, "é" * 10: 5}
        want = []
        for page, _, html in rows:
            raw = (html or "").encode()
            first = page == top[html or ""] or len(raw) < least
            want.append((page, len(raw), warc.sha1_base32(raw), "response" if first else "revisit", None if first else top[html or ""]))
        assert got == sorted(want, key=repr)


def test_notices_of_all_blocks_against_all_templates(spark):
    """What the join finds, named or not, is what counting the words of every template in every block finds."""
    odd = " ".join(text for _, text in licenses.TEMPLATES)
    rows = [(-1, odd), (-2, odd.replace(" ", "\n")), (-3, "Released under\nthe Apache License"), (-4, None)]
    docs = documents(spark).select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {}
    for doc, text in docs.collect():
        found = want.setdefault(doc, {})
        paragraphs = "\n".join(line if licenses.words(line) else "" for line in (text or "").split("\n")).split("\n\n")
        for block in [*(text or "").split("\n"), *paragraphs]:
            own = set(licenses.words(block))
            for number, (_, template) in enumerate(licenses.TEMPLATES):
                needed = set(licenses.words(template))
                if len(own & needed) >= math.ceil(0.8 * len(needed) - 1e-9):
                    found[number] = max(found.get(number, 0), len(own & needed) / len(needed))
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert {d: {m.template: m.containment for m in r.matches} for d, r in got.items()} == want
    assert any(want.values()) and not any(m.named for m in got[-3].matches) and got[-3].labels == ""
    for r in got.values():
        assert {m.label for m in r.matches if m.named} | set(filter(None, r.base_labels.split(","))) == set(filter(None, r.labels.split(",")))


def test_a_long_text_of_phrases_is_scanned_in_one_pass():
    text = "under the MIT license, and Apache License, Version 2! " * 200_000
    began = time.time()
    found = licenses.phrase_places(licenses.words(text))
    assert time.time() - began < 5 and len(text) > 10_000_000
    assert len(found) == 400_000 and found[:3] == [(0, "mit"), (5, "apache-2"), (9, "mit")]


def test_a_conversation_of_a_hundred_thousand_turns(spark):
    n = 100_000
    role = F.when(F.col("id") % 5 < 3, "assistant").otherwise("user")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é<|"), "id").alias("text"))
    began = time.time()
    formatted = chat.format_chats(turns)
    (row,) = chat.chats_digest(formatted).collect()
    assert time.time() - began < 60
    loss = "".join(f"é<|{i}" for i in range(n) if i % 5 < 3)
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (n, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    (whole,) = formatted.collect()
    cut = [whole.formatted[s.start : s.start + s.length] for s in whole.loss_spans]
    assert cut == [f"é\\1{i}" for i in range(n) if i % 5 < 3]


@pytest.mark.parametrize("kind", ["width 1", "width 2", "width 4", "offset", "clusters", "one way"])
def test_near_vectors_ends_and_finds_the_links_of_awkward_vectors(spark, kind):
    random = np.random.default_rng(5)
    width = {"width 1": 1, "width 2": 2, "width 4": 4, "clusters": 4}.get(kind, 64)
    vectors = random.standard_normal((700, width))
    if kind == "offset":
        vectors += 5
    elif kind == "clusters":
        vectors = vectors[random.integers(0, 9, len(vectors))] + 0.02 * vectors
    elif kind == "one way":
        vectors = np.abs(vectors[:, :1]) * np.ones((1, width)) + 1e-9 * vectors
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    wanted = near.sum(axis=1) - 1
    got = {r.vec_id: r for r in itq.near_vectors(frame, block=256).collect()}
    found = np.array([got[i].n_links for i in range(len(vectors))])
    assert (found <= wanted).all() and found.sum() >= 0.9 * wanted.sum()
    links = [(a, b) for a, b in zip(*np.nonzero(near)) if a < b]
    if found.sum() == wanted.sum():
        assert {i: r.component_id for i, r in got.items()} == brute.roots(range(len(vectors)), links)


def payloads(spark, paths):
    back = warc.read_archives(spark.createDataFrame([(p,) for p in paths], "path string"), together=3, piece=2000)
    return sorted(((r.page_id, bytes(r.payload)) for r in back.where("record_type = 'response'").collect()), key=repr)


def test_archives_are_read_from_files(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").limit(20)
    want = sorted({(r.page_id, (r.html or "").encode()) for r in pages.collect()}, key=repr)
    for wide in (0, 100):
        folder = f"file://{tmp_path}/{wide}"
        written = warc.write_archives(warc.plan_records(pages), folder, 20_000, wide).collect()
        again = warc.write_archives(warc.plan_records(pages), folder, 20_000, wide).collect()
        assert written == again and len(written) > 1 and sum(r.records for r in written) == 20
        assert payloads(spark, [r.path for r in written]) == want
        (first, *_) = [(tmp_path / str(wide) / r.path.rsplit("/", 1)[1]).read_bytes() for r in written]
        assert (warc.END64 in first) == (wide == 100)


ODD_URLS = ["http://x/\u2028a\u000bb {c", " {", "", "\n\r\x85\x1c", "http://x/%7B {\"offset\": 3}", None, "\u00a0é 🙂"]


def test_no_url_ends_the_run(spark):
    rows = [(i, url, f"page {i}") for i, url in enumerate(ODD_URLS)]
    back = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in back) == [(i, html) for i, _, html in rows]
    assert {r.page_id: r.url for r in back}[0] == ODD_URLS[0]


def test_a_package_above_four_gib_is_read_by_ranges(spark, tmp_path):
    """A sparse file: the second record, the index and the directory lie beyond what 32 bits can say."""
    far = (1 << 32) + 12_345
    records = [warc.warc_record(i, "http://x/", t, warc.sha1_base32(t), None) for i, t in enumerate((b"near", b"far"))]
    size = far + len(records[1])
    index = "".join(
        f"x 19700101000000 {json.dumps({'offset': at, 'length': len(r)})}\n" for at, r in zip((0, far), records)
    ).encode()
    with open(tmp_path / "large.wacz", "wb") as out:
        head = warc.local_header(warc.WARC_MEMBER, size, 0, True)
        out.write(head + records[0])
        out.seek(len(head) + far)
        out.write(records[1])
        at = out.tell()
        out.write(warc.local_header(warc.INDEX_MEMBER, len(index), zlib.crc32(index), True) + index)
        members = [(warc.WARC_MEMBER, size, 0, 0, True), (warc.INDEX_MEMBER, len(index), zlib.crc32(index), at, True)]
        out.write(warc.directory(members, out.tell(), False))
    assert payloads(spark, [str(tmp_path / "large.wacz")]) == [(0, b"near"), (1, b"far")]
    (tmp_path / "cut.wacz").write_bytes(warc.zip_package([(warc.WARC_MEMBER, records[0]), (warc.INDEX_MEMBER, index)]))
    with pytest.raises(Exception, match="outside its member"):
        payloads(spark, [str(tmp_path / "cut.wacz")])


def test_document_classes_equal_all_pairs(spark, odd):
    docs = documents(spark).select("doc_id", "text").where("doc_id > 20").union(odd.select("doc_id", "text").where("doc_id is not null"))
    want, links = brute.document_classes([(r.doc_id, r.text) for r in docs.distinct().collect()])
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == want and links


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(20)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.roots(sorted({x for e in edges if e[0] != e[1] for x in e}), edges)


def test_components_where_tasks_forget(spark, monkeypatch):
    monkeypatch.setattr(common, "FOREST", 5)
    random = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (330, 2)) if a != b] + [(500, i) for i in range(0, 60, 2)]
    edges += [(1000 + i, 1001 + i) for i in range(0, 60)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == brute.roots(sorted({x for e in edges if e[0] != e[1] for x in e}), edges)


def test_components_shuffle_once_a_round(spark, monkeypatch):
    plans, plain = [], common.stored

    def seen(df, label):
        plans.append((label, plan_of(df, "simple").count("Exchange hashpartitioning")))
        return plain(df, label)

    monkeypatch.setattr(common, "stored", seen)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(20)]
    common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sum(n for _, n in plans) <= sum(label == "ends" for label, _ in plans) <= 4


def test_vectors_against_all_pairs(spark):
    random = np.random.default_rng(0)
    base = random.standard_normal((300, 32))
    noise = random.standard_normal((300, 32)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + noise, base[:40]]))]
    rows += [(900, None), (901, [0.0] * 32), (902, [math.nan] * 32), (903, [1.0]), (None, rows[0][1])]
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, n int")
    flat = np.array([v for _, v in rows[:640]] + [rows[0][1]])
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    near = flat @ flat.T >= 0.95
    got = {r.vec_id: r for r in itq.near_vectors(vectors, sample_rows=500).collect()}
    want = near.sum(axis=1) - 1
    assert sum(got[i].n_links for i in range(640)) >= 0.9 * want[:640].sum()
    assert all(got[i].n_links <= want[i] for i in range(640))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 904))
    assert got[0].component_id == got[300].component_id == got[600].component_id == 0
    assert got[None].n_links >= 1 and got[None].component_id is None


def test_languages_of_texts_not_learnt_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98
    assert got.where("rejected").count() <= 10


def test_a_rare_language_is_kept_however_small_the_shards(spark):
    """Twelve texts of a fifth language beside a thousand of four others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto"
    words = finnish.split()
    rare = [(10**9 + i, " ".join(words[i:] + words[:i]), "fi") for i in range(12)]
    both = docs.union(spark.createDataFrame(rare, docs.schema))
    labels, shards = language_id.train(both, 200_000)
    assert labels == ["de", "en", "es", "fi", "fr"] and len(list(shards)) > 5
    for size in (64 << 20, 1 << 20):
        got = language_id.identify(both, shard_bytes=size).join(both.select("doc_id", "lang"), "doc_id")
        assert got.where("lang = 'fi' AND lang_pred <> 'fi'").isEmpty()
        assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


def test_strange_and_empty_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, None, "en"), (-2, "12 34", None), (-3, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και ζαφείρι δέξου πάγκαλο " * 9, None)]
    got = language_id.identify(docs.union(spark.createDataFrame(odd, docs.schema))).where("doc_id < 0").collect()
    assert {r.doc_id: (r.lang_pred == "und", r.rejected) for r in got} == {-1: (True, True), -2: (True, True), -3: (False, True)}


def test_stages_of_the_pipeline(spark):
    docs, sizes = documents(spark), []
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert set(ids(docs)) <= set(ids(before))
        sizes.append(len(set(ids(docs))))
    assert sizes[0] == sizes[1] > sizes[2] == sizes[3]
    last = corpus_pipeline.pack_windows(spark, docs, FOLDER)
    check_pieces(last.collect(), docs.select("doc_id", "text").collect())


def test_run_keeps_what_plain_versions_of_the_stages_keep(spark):
    """run() on whole small tables: its documents are those of a chain of plain versions, clean ones are kept, and
    its pieces are all their tokens, as often as mixing draws them."""
    rejected = {r.doc_id for r in language_id.identify(documents(spark)).where("rejected").collect()}
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    rows = brute.without_common_lines([r for r in rows if r[0] not in rejected])
    classes, _ = brute.document_classes(rows)
    kept = {doc: text for doc, text in rows if classes[doc] == doc}
    drawn = {}
    for p in corpus_pipeline.run(spark, FOLDER).collect():
        drawn.setdefault(p.doc_id, []).append(p)
    assert set(drawn) == set(kept)
    encode = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode_ordinary
    for doc, text in kept.items():
        tokens = len(encode(text or "")) + 1
        assert {p.doc_tokens for p in drawn[doc]} == {tokens}
        times = sum(p.length for p in drawn[doc]) / tokens
        assert times in (1, 2)
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    gone = good & {doc for doc, _ in rows} - set(kept)
    assert good.isdisjoint(rejected) and all(classes[doc] != doc for doc in gone)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_and_empty_tables(odd, spark, empty):
    docs = odd.limit(0) if empty else odd
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, FOLDER), name)
    assert docs.isEmpty() == empty


def test_mixing_by_tokens_that_were_counted(spark):
    rows = [(i, "x" * 400, "a" if i < 90 else "b", 1000 if i < 90 else None) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens long")
    mixed = mixing.mix(docs, max_repeats=1.0, tokens=F.col("tokens")).collect()
    assert {(r.source, r.tokens) for r in mixed} == {("a", 1000), ("b", 1)}
    weights = {r.source: r.weight for r in mixed}
    assert weights["a"] == pytest.approx(90_000 / 90_010) and len(mixed) == 100


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
