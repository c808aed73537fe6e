"""Parts that need no Spark."""

import io
import itertools
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest

from earshot.llm import fertility, itq, language_id, licenses, line_dedup, order_minhash, packing, warc
from tests.llm import brute


def test_vocabulary_files_give_the_same_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    texts = ["", "a", "  two  blanks\n\n\tand tabs ", "<|endoftext|> it's", "naïve Ünïcödé 中文字 ١٢٣ ²³ 🙂🙂", "x" * 3000]
    for text in texts:
        assert packing.tokenizer(path).encode_ordinary(text) == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("weights", [None, {"a": 1, "b": 3}, {"a": 0, "b": 1, "c": 1}])
def test_pieces_cover_the_merged_stream_once_in_proportion(weights):
    totals = {"a": 5000, "b": 12345, "c": 7, None: 300}
    queues, length, quantum = packing.quanta(totals, 64, weights)
    seen = np.zeros(sum(totals.values()), int)
    owner = np.full(len(seen), -1)
    for q in range(len(queues)):
        cuts = sorted({0, int(length[q]), *np.random.default_rng(q).integers(0, length[q], 9).tolist()})
        for start, stop in zip(cuts, cuts[1:]):
            low, place, size = packing._pieces(start, stop, q, length, quantum, 64)
            assert low[0] == start and size.sum() == stop - start and (low[1:] == (low + size)[:-1]).all()
            assert (place // 64 == (place + size - 1) // 64).all()
            for p, n in zip(place, size):
                seen[p : p + n] += 1
                owner[p : p + n] = q
    assert (seen == 1).all()
    if weights is None:
        big = queues.index("b")
        share = [(owner[i * 64 : i * 64 + 64] == big).mean() for i in range(len(seen) // 64)]
        assert max(share) - min(share) < 0.1


def test_padding():
    assert [packing.padding(2048, n) for n in (2048, 1024, 1, 1000)] == [0, 0, 0, 1048]


def test_minimal_perfect_hash():
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    levels = line_dedup.build_hash(np.unique(keys))
    assert sorted(line_dedup.places(levels, np.unique(keys))) == list(range(len(np.unique(keys))))
    assert line_dedup.places(line_dedup.build_hash(keys[:0]), keys[:3]).tolist() == [-1] * 3


def test_base_counts_equal_plain_ones():
    words = "a b c d".split()
    random.seed(1)
    for n in (0, 1, 2, 3, 5, 40):
        text = [random.choice(words) for _ in range(n)]
        windows = list(zip(text, text[1:], text[2:]))
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert fertility.repeated_words(np.array([words.index(w) for w in text], np.int64)) == len(hit)
    assert fertility.duplicate_lines(b"x\n\nx\n \n\ny\nx") == 2


def test_containment_join_equals_counting_all_pairs():
    random.seed(2)
    counts = {w: random.randrange(50) for _, t in licenses.TEMPLATES for w in licenses.words(t)}
    index = licenses.Index(licenses.TEMPLATES, counts, 0.8)
    for _ in range(300):
        _, text = random.choice(licenses.TEMPLATES)
        own = licenses.words(text)
        block = set(random.sample(own, random.randrange(len(own)))) | {b"other", b"words"}
        sets = [set(licenses.words(t)) for _, t in licenses.TEMPLATES]
        want = {(n, len(s & block) / len(s)) for n, s in enumerate(sets) if len(s & block) >= 0.8 * len(s) - 1e-9}
        assert set(index.matches(block)) == want


def test_phrases_stand_on_whole_words():
    words = licenses.words("Under the MIT license! under the mit license, not summit license. CC-BY-NC")
    assert licenses.phrase_places(words) == [(0, "mit"), (4, "mit"), (11, "cc-by-nc")]


@pytest.mark.parametrize("wide", [False, True])
def test_packages_are_read_like_any_zip(wide):
    members = [("archive/data.warc", b"x" * 1000), ("indexes/index.cdxj", "é".encode()), ("empty", b"")]
    raw = warc.zip_package(members, wide)
    with zipfile.ZipFile(io.BytesIO(raw)) as plain:
        assert [(n, plain.read(n)) for n in plain.namelist()] == members
    package = warc.Zip(io.BytesIO(raw))
    assert [(n, package.read(*package.place(n))) for n in package.members] == members


def test_damaged_and_compressed_packages_are_refused():
    with pytest.raises(ValueError):
        warc.Zip(io.BytesIO(b"no archive"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc.Zip(out).place("a")


def test_records_survive_gzip_and_odd_urls():
    raw = warc.warc_record(7, "http://x/\r\ny", b"a\r\n\r\nb", warc.sha1_base32(b"a\r\n\r\nb"), None)
    packed = zlib.compressobj(wbits=31)
    both = [warc.parse_record(r) for r in (raw, packed.compress(raw) + packed.flush())]
    assert both[0] == both[1] and both[0]["payload"] == b"a\r\n\r\nb"
    assert both[0]["fields"]["warc-target-uri"] == "http://x/%0D%0Ay"


def test_alignment_equals_the_plain_recurrence():
    random.seed(3)
    for _ in range(200):
        words = [random.choice("abcdefgh") for _ in range(random.randrange(1, 60))]
        other = [w for w in words if random.random() > 0.03]
        if other and random.random() < 0.5:
            other.insert(random.randrange(len(other)), "z")
        x, y = (order_minhash.labelled_kmers(order_minhash.normalized(" ".join(t)), 5) for t in (words, other))
        a, b = brute.labelled_runs(" ".join(words)), brute.labelled_runs(" ".join(other))
        matched = brute.longest_common(a, b)
        want = matched / (len(a) + len(b) - matched) if a and b else 0.0
        got = order_minhash.alignment(x, y, 0.8)
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_sketches_tell_order():
    text = [f"w{i}" for i in range(60)]
    one, same, turned = (
        order_minhash.sketch(order_minhash.labelled_kmers(" ".join(t).encode(), 1), 16, 3)
        for t in (text, list(text), text[::-1])
    )
    assert (one == same).all() and (one != turned).all()


def test_codes_are_balanced():
    rows, _ = itq.unit_rows(list(np.random.default_rng(0).standard_normal((2000, 16))), 16)
    share = itq.encode(rows, *itq.learn(rows, 32)).mean(axis=0)
    assert abs(share - 0.5).max() < 0.01


@pytest.mark.parametrize("size", [8, 14, 16, 20])
@pytest.mark.parametrize("data", ["even", "clustered", "off centre"])
def test_tables_meet_pairs_whatever_the_size(size, data):
    random = np.random.default_rng(7)
    flat = random.standard_normal((8000, 64))
    if data == "clustered":
        flat = random.standard_normal((50, 64))[random.integers(0, 50, 8000)] + 0.5 * flat
    flat += 0.5 * (data == "off centre")
    rows, _ = itq.unit_rows(list(flat), 64)
    away = random.standard_normal((4000, 64))
    away -= (away * rows[4000:]).sum(axis=1, keepdims=True) * rows[4000:]
    away /= np.sqrt((away**2).sum(axis=1, keepdims=True))
    cosine = random.uniform(0.95, 0.96, (4000, 1))
    near = cosine * rows[4000:] + np.sqrt(1 - cosine**2) * away
    projection, thresholds, chosen = itq.layout(rows[:4000], 1 << (size + 6), 0.95, 0.99, 64, 16, 64, size)
    assert chosen.shape[1] == size
    one, other = (itq.table_keys(itq.encode(x, projection, thresholds), chosen) for x in (rows[4000:], near))
    assert (one == other).any(axis=1).mean() >= 0.98


def test_useless_vectors():
    rows, good = itq.unit_rows([[3e200, 4e200], None, [0, 0], [float("nan"), 1], [1, None], [1], [1e-200, 0]], 2)
    assert good.tolist() == [True, False, False, False, False, False, True]
    assert rows[0] == pytest.approx([0.6, 0.8])


MODEL_TEXTS = {"x": ["abra cadabra", "cab"], "y": ["banana bandana ab", "nab"], "z": ["\u00e9"]}


def learnt(spark, shard_bytes):
    """Models of MODEL_TEXTS, from documents of a fold that is learnt from."""
    rows = [(lang, text) for lang, texts in MODEL_TEXTS.items() for text in texts]
    docs = spark.createDataFrame([(4 * i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    numbers = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 < 2]
    docs = spark.createDataFrame([(numbers[i], *r) for i, r in enumerate(rows)], docs.schema)
    labels, shards = language_id.train(docs, shard_bytes)
    return labels, list(shards)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1])
def test_probabilities_are_those_of_the_definition(spark, shard_bytes):
    labels, shards = learnt(spark, shard_bytes)
    assert labels == ["x", "y", "z"] and (len(shards) > 3) == (shard_bytes == 1)
    plain = {x: brute.kneser_ney([[ord(c) for c in t] for t in texts]) for x, texts in MODEL_TEXTS.items()}
    alphabet = np.arange(1 << 16, dtype=np.uint64)
    for context in ("abr", "ban", "zzz", " ba", "\x01\x01\x01", "\x01ca", "xan"):
        a, b, c = (np.uint64(ord(x)) for x in context)
        keys = a << np.uint64(48) | b << np.uint64(32) | c << np.uint64(16) | alphabet
        (own,) = [s for s in shards if s.low <= ord(context[2]) <= s.high]
        got = np.exp(own._score(keys, 4).astype(float))
        assert got.sum(axis=0) == pytest.approx([1, 1, 1], abs=1e-3)
        for char in "abcnr dz\u00e9":
            want = [plain[x](tuple(map(ord, context)), ord(char)) for x in labels]
            assert got[ord(char)] == pytest.approx(want, rel=1e-4)


def test_shards_together_say_what_one_says(spark):
    texts = ["banana abra", None, "", "12", "abc\u00e9 zzz nab" * 50, "\u00e9"]
    whole, parts = (language_id.totals(texts, learnt(spark, n)[1], 3) for n in (1 << 20, 1))
    assert (whole[0] == parts[0]).all() and whole[1] == pytest.approx(parts[1])


def test_letters_of_each_text_are_its_own():
    chars, owner = language_id.letters(["  A1b!! ", None, "", "é"])
    edge = [language_id.EDGE] * 3
    assert chars.tolist() == [*edge, 97, 32, 98, *edge, *edge, *edge, 233]
    assert [sum(owner == i) - 3 for i in range(4)] == [3, 0, 0, 1]


def test_hash_arrays_find_what_is_there():
    keys = np.unique(np.random.default_rng(5).integers(0, 2**60, 3000).astype(np.uint64))
    table = language_id.HashArray(keys[::2], np.arange(len(keys[::2]))[:, None])
    found = table.find(keys)
    assert (found[1::2] == -1).all() and (table.values[found[::2], 0] == np.arange(len(keys[::2]))).all()


def test_components_of_pairs_in_plain_form():
    assert brute.roots([1, 2, 3, 4], list(itertools.pairwise([2, 3, 4]))) == {1: 1, 2: 2, 3: 2, 4: 2}
