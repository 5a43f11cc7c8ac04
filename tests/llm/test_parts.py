"""The pieces that the operators are made of."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlens.llm import fingerprints, language_id, ngram_join, packing, suffix_dedup, toxicity, units, vector_search
from bazaarlens.llm.common import checkpointed, components, range_bounds, range_number, shared_dir, steps
from bazaarlens.llm.hashing import PrefixHash
from bazaarlens.llm.vector_search import fit


def test_the_shared_folder_is_the_one_the_session_names(spark, monkeypatch):
    own = shared_dir(spark)
    assert shared_dir(spark) in own or own in shared_dir(spark)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: f"file:///of/{key}")
    assert shared_dir(spark) == "file:///of/spark.checkpoint.dir"


def test_components(spark):
    # a chain, a star, a pair given both ways and a node alone
    edges = [(i, i + 1) for i in range(10, 40)] + [(99, i) for i in range(100, 160)] + [(1, 2), (2, 1)]
    nodes = sorted({x for e in edges for x in e} | {7})
    got = components(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long")
    )
    want = {n: 1 if n < 3 else 7 if n == 7 else 10 if n < 50 else 99 for n in nodes}
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_range_number_counts_the_bounds_below(spark):
    frame = spark.range(-5, 1000).withColumnRenamed("id", "x")
    for parts in (1, 2, 7, 40):
        bounds = range_bounds(frame, "x", parts)
        rows = frame.select("x", range_number(F.col("x"), bounds).alias("n")).collect()
        assert all(r["n"] == sum(b <= r["x"] for b in bounds) for r in rows)
    assert frame.limit(1).select(range_number(F.lit(None).cast("long"), [3]).alias("n")).first()["n"] == 0


def test_steps_cover_all_rows():
    ends = np.cumsum([0, 5, 0, 50, 1, 1, 200, 3])
    found = list(steps(ends, 55))
    assert found[0][0] == 0 and found[-1][1] == 7
    assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
    assert all(ends[b] - ends[a] <= 55 or b == a + 1 for a, b in found)


@given(st.binary(max_size=60), st.data())
@settings(max_examples=200, deadline=None)
def test_equal_pieces_have_equal_hashes_and_others_do_not(raw, data):
    hashes = PrefixHash(np.frombuffer(raw, np.uint8))
    spot = st.integers(0, len(raw))
    a, b, c, d = (data.draw(spot) for _ in range(4))
    a, b, c, d = min(a, b), max(a, b), min(c, d), max(c, d)
    x, y = hashes.pieces(np.array([a, c]), np.array([b, d])).tolist()
    assert (x == y) == (raw[a:b] == raw[c:d])


def test_suffixes_are_sorted_and_repeats_found():
    random = np.random.default_rng(4)
    data = random.integers(97, 99, 3000).astype(np.uint8)
    data[500:900] = data[1500:1900]
    data[2200:2500] = 97
    places = random.permutation(len(data) - suffix_dedup.SPAN)[:1500]
    group = np.sort(random.integers(0, 3, len(places)))
    suffixes = suffix_dedup.Suffixes(data)
    order = suffixes.sorted(places, group)
    windows = [data[p : p + suffix_dedup.SPAN].tobytes() for p in places]
    assert [(g, windows[i]) for g, i in zip(group, order)] == sorted(zip(group.tolist(), windows))
    counts = {}
    for g, w in zip(group.tolist(), windows):
        counts[g, w] = counts.get((g, w), 0) + 1
    assert suffixes.repeats(places, group).tolist() == [counts[g, w] > 1 for g, w in zip(group.tolist(), windows)]


def test_a_lying_hash_is_noticed(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 1000).astype(np.uint8)
    suffixes = suffix_dedup.Suffixes(data)
    suffixes.hashes.raw = lambda start, end: np.zeros(len(start), np.uint64)
    assert suffixes.repeats(np.array([0, 300]), np.array([0, 0])) is None


def test_fingerprints_are_homomorphic():
    exact, near = fingerprints.vectors([b"first line\nsecond", b"third one here", b"third one here\nsecond\nfirst line"])
    whole = fingerprints.add((exact[:1], near[:1]), (exact[1:2], near[1:2]))
    assert (whole[0] == exact[2:]).all() and (whole[1] == near[2:]).all()
    back = fingerprints.remove(whole, (exact[1:2], near[1:2]))
    assert (back[0] == exact[:1]).all() and (back[1] == near[:1]).all()
    assert fingerprints.likeness(whole, (exact[2:], near[2:])).tolist() == [1.0]
    twice = fingerprints.vectors([b"a\na", b"a", b"", b"\n"])[0]
    assert len({x.tobytes() for x in twice}) == 4


def test_likeness_follows_the_shared_part():
    random = np.random.default_rng(2)
    words = ["".join(random.choice(list("abcdefgh"), 6)) for _ in range(600)]
    texts = [" ".join(words[:300]), " ".join(words[:225] + words[300:375]), " ".join(words[300:])]
    exact, near = fingerprints.vectors([t.encode() for t in texts])
    first = (exact[:1].repeat(2, 0), near[:1].repeat(2, 0))
    some, none = fingerprints.likeness(first, (exact[1:], near[1:]))
    assert abs(some - 0.75) < 0.15 and none < 0.15


def test_hilbert_neighbours_are_neighbours():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1).T
    place = packing.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


@pytest.fixture(scope="module")
def tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.Encoder(path), Tokenizer.from_file(path)


@given(st.lists(st.text(st.sampled_from("abzAZ019 \n\t'srteÉßñş½!?<|>-_—日Σİ\x85\xa0\x1c\x00"), max_size=40), max_size=4))
@settings(max_examples=150, deadline=None)
def test_encoder_gives_the_tokenizers_ids(tokenizer, texts):
    fast, slow = tokenizer
    texts = [*texts, "it's we'LL <|endoftext|> 12½ ŉſ don't!!'s", ""]
    want = [[*slow.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [x.tolist() for x in fast.ids(texts)] == want


def test_encoder_forgets_and_goes_on(tokenizer, monkeypatch):
    fast, slow = tokenizer
    monkeypatch.setattr(fast.known, "most", 5)
    for i in range(6):
        text = f"one two three {'abcdef'[i] * 3} x{i} y{i}z"
        assert fast.ids([text])[0].tolist() == [*slow.encode(text, add_special_tokens=False).ids, 2]


def thue_morse(log2):
    """The word and its complement, which collide modulo 2^64 for any odd base."""
    bits = np.zeros(1, np.uint8)
    for _ in range(log2):
        bits = np.concatenate([bits, 1 - bits])
    return tuple((97 + x).astype(np.uint8).tobytes().decode() for x in (bits, 1 - bits))


@pytest.mark.parametrize("log2", [10, 11, 14])
def test_thue_morse_words_have_ids_and_grams_of_their_own(tokenizer, log2):
    fast, slow = tokenizer
    a, b = thue_morse(log2)
    hashes = PrefixHash(np.frombuffer((a + b).encode(), np.uint8))
    ends = np.array([len(a), 2 * len(a)])
    assert len(set(hashes.raw(ends - len(a), ends).tolist())) == 1  # the sum modulo 2^64 alone
    assert len(set(hashes.pieces(ends - len(a), ends).tolist())) == 2
    want = [[*slow.encode(t, add_special_tokens=False).ids, 2] for t in (a, b, f"{a} {b}")]
    assert [x.tolist() for x in fast.ids([a, b, f"{a} {b}"])] == want
    data = np.frombuffer(f"{a} x{b} x".encode(), np.uint8)
    one, two = ngram_join.grams(data, np.array([0, len(a) + 2, len(data)]), 1)
    assert len(np.intersect1d(one, two)) == 1


def test_long_texts_are_encoded_in_pieces(tokenizer):
    fast, slow = tokenizer
    words = ["wort", "élan", "x2", "don't", "\n\n", "  ", "--", "日本"]
    dice = np.random.default_rng(3)
    long = " ".join(words[i] for i in dice.integers(0, 7, 500_000))
    texts = ["first", long, "", long[:1_500_000] + " 日本 " + long[:900_000], "last"]
    assert sum(len(p) for p in units.pieces(long)) + sum(1 for _ in units.pieces(long)) - 1 == len(long)
    want = [[*slow.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [x.tolist() for x in fast.ids(texts)] == want


@given(st.lists(st.text(st.sampled_from("ab \n"), max_size=30), max_size=6), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_stretches_hold_all_texts(texts, most):
    found, now = [], ""
    for held, ends in units.stretches(texts, most):
        assert len(held) == len(ends) and held
        for piece, end in zip(held, ends):
            now += piece
            if end:
                found.append(now)
                now = ""
            else:
                now += " "
    assert found == texts and now == ""


@given(st.text(st.sampled_from("ab \n"), max_size=60), st.integers(1, 4), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_grams_of_long_texts(text, n, most):
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.array([0, len(data)])
    words = text.split()
    whole = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    found = ngram_join.grams(data, ends, n, most)[0]
    assert len(found) == len(whole)
    if all(len(w) <= 2 * most for w in words):
        assert found.tolist() == ngram_join.grams(data, ends, n)[0].tolist()
    # a word has one hash wherever it stands
    later = np.frombuffer(b"xx y " + data.tobytes(), np.uint8)
    if n == 1 and len(data) > most:
        assert np.isin(found, ngram_join.grams(later, np.array([0, len(later)]), n, most)[0]).all()


def test_the_rest_is_cut_into_powers_of_two():
    for total in (0, 1, 4095, 4096, 4097, 10_000):
        cuts = packing._cuts(total, 4096)
        sizes = np.diff(cuts)
        assert cuts[0] == total - total % 4096 and cuts[-1] == total
        assert all(x & (x - 1) == 0 for x in sizes.tolist())


def test_restoration():
    text = " ".join(["such an idiot here", "pathetic trash stupid clown", "worthless scum", "the other one"] * 50)
    symbols = toxicity._SYMBOL[np.frombuffer(text.encode(), np.uint8)]
    counts = np.bincount((symbols[:-2] * 27 + symbols[1:-1]) * 27 + symbols[2:], minlength=27**3).astype(float)
    restorer = toxicity.Restorer(toxicity.costs(counts))
    for seen, meant in [
        ("1d10t", "idiot"), ("p@th3tic", "pathetic"), ("tr4sh", "trash"), ("stuuuuupid", "stupid"),
        ("i.d.i.o.t", "idiot"), ("$cum!", "scum"), ("plain", "plain"), ("2023", "2023"), ("here!!", "here!!"),
    ]:
        assert restorer.word(seen) == meant, seen
    assert restorer.text("Such an I D I O T here") == "such an idiot here"


def test_a_fitted_index_finds_near_vectors():
    random = np.random.default_rng(9)
    base = random.normal(size=(3000, 24))
    base[:1000] = base[0] + random.normal(size=(1000, 24)) * 1e-3
    index = fit(base, len(base))
    units = base / np.linalg.norm(base, axis=1, keepdims=True)
    member = np.zeros((len(base), len(index.centroids)), bool)
    member[index.lists(units)] = True
    assert member.any(1).all()
    asked = np.arange(0, 3000, 25)
    row, at = index.probes(units[asked])
    read = np.zeros((len(asked), len(index.centroids)), bool)
    read[row, at] = True
    cosine = units[asked] @ units.T
    cosine[np.arange(len(asked)), asked] = -2
    true = np.argsort(-cosine, axis=1)[:, :5]
    hit = [(member[t] & read[i]).any(1).mean() for i, t in enumerate(true)]
    assert np.mean(hit) >= 0.9


def test_a_search_holds_one_group_and_copies_no_posting(spark, monkeypatch):
    """With small groups, and so many query batches, the rows that are shuffled are the postings and
    the queries' visits; the lists grow with the table."""
    random = np.random.default_rng(5)
    centers = random.normal(size=(40, 16))
    base = centers[random.integers(0, 40, 4000)] + 0.2 * random.normal(size=(4000, 16))
    base[:1200] = base[0]  # a third of all are one vector
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>").repartition(4)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 64)
    seen = []
    monkeypatch.setattr(vector_search, "checkpointed", lambda frame: seen.append(frame) or checkpointed(frame))
    found = vector_search.nearest(rows, F.col("vec_id") % 2 == 0)
    # what is shuffled by group is a union of the postings and the visits: nothing makes copies of rows
    assert not any("Generate" in frame._jdf.queryExecution().executedPlan().toString() for frame in seen)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    units = base / np.linalg.norm(base, axis=1, keepdims=True)
    cosine = units @ units.T
    np.fill_diagonal(cosine, -2)
    hit = 0
    for i in range(0, 4000, 2):
        best = sorted(got[i])
        assert [r for r, _, _ in best] == [1, 2, 3, 4, 5] and i not in [v for _, v, _ in best]
        assert np.allclose([s for _, _, s in best], [cosine[i, v] for _, v, _ in best])
        hit += sum(cosine[i, v] >= np.sort(cosine[i])[-5] - 1e-9 for _, v, _ in best)
    assert hit / 10_000 >= 0.9
    sizes = [len(fit(random.normal(size=(8 * n, 8)), (n // 2) ** 2).centroids) for n in (64, 256, 512)]
    assert sizes[0] < sizes[1] < sizes[2]


@pytest.mark.parametrize("ids", [[7] * 900 + [1, 2, 50, 100], [50, 100, 1], [50]])
def test_each_query_gets_k_neighbours_if_there_are_so_many(spark, ids):
    """One id with very many rows, and tables of fewer than k."""
    random = np.random.default_rng(len(ids))
    base = random.normal(size=(len(ids), 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, base)], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_search.nearest(rows, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    units = base / np.linalg.norm(base, axis=1, keepdims=True)
    for q in set(ids) & {50, 100}:
        best = {}
        for i, v in zip(ids, units):
            if i != q:
                best[i] = max(best.get(i, -2), float(v @ units[ids.index(q)]))
        want = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5])
        assert got.get(q, {}).keys() == want.keys() and np.allclose([got[q][i] for i in want], list(want.values()))


@given(st.text(st.sampled_from("ab\n"), max_size=80), st.integers(1, 12))
@settings(max_examples=300, deadline=None)
def test_fingerprints_of_long_texts_are_sums_of_their_parts(text, most):
    whole = fingerprints.vectors([text.encode()])
    exact, near = fingerprints._long(text.encode(), most)
    assert (exact == whole[0][0]).all() and (near == whole[1][0]).all()


def test_long_texts_keep_their_language():
    pieces = [("xx", b"alpha beta gamma delta " * 8), ("yy", b"une chose et une autre " * 8)] * 20
    frame = language_id.pd.DataFrame({"lang": [x for x, _ in pieces], "held": [i % 5 == 0 for i in range(40)], "piece": [p for _, p in pieces]})
    model = language_id.train(frame)
    for text, at in ((b"alpha beta 12 gamma " * 500, 0), (b"une autre; chose " * 500, 1), (b"alphabetagamma" * 700, 0)):
        data = np.frombuffer(text, np.uint8)
        ends = np.array([0, len(data)])
        assert b"".join(p.tobytes() for p in language_id._pieces(data, 100)) == text
        one, many = model.scores(data, ends), model.scores(data, ends, 1000)
        assert one.argmax() == many.argmax() == at and abs(one - many).max() < 0.02


def test_the_language_sample_is_bounded_whatever_the_ids(spark):
    """Null and repeated ids are drawn apart, and equal rows count once."""
    rows = [(None, f"text number {i} of many words", "en") for i in range(900)]
    rows += [(5, "the very same text", "en")] * 900 + [(i, f"ein Text {i}", "de") for i in range(30)] + [(1, "12", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = language_id.sample(docs, F.lit(True), per_language=100)
    counts = found["lang"].value_counts()
    assert 50 <= counts["en"] <= 100 and counts["de"] == 30 and "fr" not in counts


def test_rows_without_an_id_are_dealt_into_several_ranges(spark):
    dice = np.random.default_rng(3)
    texts = ["".join(dice.choice(list("aäbc \n"), dice.integers(0, 12))) for _ in range(3000)]
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(rows, key=lambda d: (d[0] is None, -(d[0] or 0), d[1].encode()))
    want = []
    for i, (doc_id, text) in enumerate(order):
        half, following = len(text) // 2, order[(i + 1) % len(order)][1]
        want.append((doc_id, len(text), fingerprints.hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    found = fingerprints.edited_pairs(docs)
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    keyed = docs.withColumn("key", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)))
    keyed = keyed.withColumn("prefix", fingerprints._prefix(F.col("text")))
    sizes = [r["count"] for r in keyed.groupBy(fingerprints._ranges(keyed, 32)).count().collect()]
    assert max(sizes) < 400 and sum(sizes) == 3000


PIECES_SEEN = st.lists(st.text(alphabet="aaabcdss$@10.-éßñ_²ⓐ™H ", min_size=1, max_size=9), min_size=1, max_size=12).map(" ".join)
BEGINNINGS = st.sets(st.text(alphabet="abcdsé", min_size=1, max_size=4).map(lambda x: (x + "$")[:4]), min_size=1, max_size=6)


@given(PIECES_SEEN, BEGINNINGS)
@settings(max_examples=300, deadline=None)
def test_pieces_told_beforehand_have_no_feature(text, starts):
    """Reading only pieces that may have a feature finds what reading all of them does."""
    model = toxicity.costs(np.arange(27**3, dtype=float) % 11)
    words = [x.removesuffix("$") for x in starts]
    spelled = {y for x in words for tail in ("", "a", "ss", "bcd") for y in toxicity.spellings(x + tail)}
    chosen = sorted({toxicity.zlib.crc32(x.encode()) for x in spelled})
    begins = frozenset(x[: toxicity.BEGINNING] for x in spelled)
    full = frozenset(x[:-1] for x in spelled if x.endswith("$"))
    reader, plain = (toxicity.Reader(model, chosen, begins, full) for _ in range(2))
    plain.may = None
    assert reader.read(text) == plain.read(text)


def test_pieces_without_a_feature_are_not_decoded(monkeypatch):
    reader = toxicity.Reader(toxicity.costs(np.ones(27**3)), [toxicity.zlib.crc32(b"scum$")], frozenset({"scum"}), frozenset({"scum"}))
    seen = []
    monkeypatch.setattr(reader.restorer, "decode", lambda x: seen.append(x) or "".join(filter(str.isalpha, x)))
    text = "w0rds th@t s.e.e.m café1 odd 4 it to be an s c u m 5cum"
    assert sum(reader.read(text).values()) >= 1
    assert "5cum" in seen and not {"w0rds", "th@t", "s.e.e.m", "café1", "it to be an"} & set(seen)
