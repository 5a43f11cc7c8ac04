"""Token alignment and pair counts, against brute force with the tokenizers themselves."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlens.llm import alignment
from bazaarlens.llm.queries import QUERIES
from bazaarlens.llm.units import byte_characters

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Both tokenizers, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.raw = {c: b for b, c in byte_characters().items()}

    def tokens(self, text):
        a = [(i, bytes(self.raw[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            return [], []
        return a, b

    def aligned(self, text):
        """Groups of ids, and the linked pairs."""
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, x in side:
                found.append((at, at + len(x), i))
                at += len(x)
            spans.append(found)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start < e <= end) for side in spans) if len(ends) < 400 else None)
            start = end
        if groups and groups[0] is None:  # the same, in one pass
            groups, places = [], [0, 0]
            for end in ends:
                told = []
                for n, side in enumerate(spans):
                    first = places[n]
                    while places[n] < len(side) and side[places[n]][1] <= end:
                        places[n] += 1
                    told.append(",".join(str(i) for _, _, i in side[first : places[n]]))
                groups.append("|".join(told))
        return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def brute(plain, texts):
    found = [plain.aligned(t or "") for t in texts]
    counts = Counter(x for f in found for x in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (
            a, b, len(groups), len(links),
            sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for a, b, groups, links in found
    ]


def test_the_query_against_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = dict(zip([r["doc_id"] for r in docs], brute(plain, [r["text"] for r in docs])))
    rows = QUERIES["op12_cross_tokenizer_alignment"](spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r[x] for x in FIELDS) for r in rows} == want and len(rows) == len(want)


ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "x▁y", "▁", "<s> </s><unk><0x41>", "<|endoftext|> x",
    "café 日本語 \U00010000 \u0085  a 　 b　c", "a\x1cb \x1c c", "it's 12 345,6  --\t\n\r\n x", "the the the the",
    "x" * 3000, "ü" * 500 + " " + "ü" * 500, "\x00 \x01 \x7f",
]


@pytest.mark.parametrize("run, radixes, fan_in", [(1 << 20, 64, 64), (1, 3, 2), (50, 1, 2)])
def test_odd_texts_and_many_runs(spark, plain, run, radixes, fan_in):
    texts = [*ODD, *(f"word{i % 7} the {i % 5} café und so weiter" for i in range(60))]
    rows = [(i % 11 if i % 13 else None, t, "own n_a", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, radix int").repartition(7)
    got = alignment.aligned(docs, A, B, run=run, radixes=radixes, fan_in=fan_in).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute(plain, texts))]
    assert sorted((tuple(r[x] for x in ["doc_id", *FIELDS]) for r in got), key=repr) == sorted(want, key=repr)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(docs, A, B).count() == 0


def test_a_very_long_text_is_read_in_pieces(spark, plain):
    dice = np.random.default_rng(1)
    words = ["the", "café", "12,5", "Ungeheuer", "x\n\ny", "", "of　it"]
    long = " ".join(words[i] for i in dice.integers(0, len(words), 450_000))
    texts = [long, "the café", long[:100_000] + "▁"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = alignment.aligned(docs, A, B, run=1000).orderBy("doc_id").collect()
    assert len(long) > 2 * (1 << 20)
    assert [tuple(r[x] for x in FIELDS) for r in got] == brute(plain, texts)


@pytest.fixture(scope="module")
def aligner():
    found = alignment.Aligner(A, B)
    found.known.most = 40
    return found


@given(st.lists(st.text(st.sampled_from("ab \n\t'sZ019.,éü日 ▁\u0085\x1c"), min_size=1, max_size=30), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_units_give_the_tokenizers_groups(aligner, plain, texts):
    rows, first = aligner.read(texts)
    for text, p, q in zip(texts, first, [*first[1:], len(rows)]):
        a, b, groups, links = plain.aligned(text)
        own = aligner.numbers[rows[p:q]].sum(0).tolist()
        if a:
            assert own == [a, b, len(groups), len(links), 0]
            assert b";".join(aligner.groups[i] for i in rows[p:q].tolist()).decode() == ";".join(groups)
            keys, _ = aligner.pairs.take(rows[p:q])
            assert Counter(keys.tolist()) == Counter(y * aligner.a.size + x for x, y in links)
        else:
            assert own[4] > 0


@given(st.lists(st.lists(st.integers(0, 60), max_size=40), max_size=9), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_runs_merge(runs, block):
    packed, want = [], Counter()
    for keys in runs:
        own, times = alignment.summed(np.array(keys, np.uint64), np.ones(len(keys), np.int64))
        packed.append((alignment.pack(np.diff(own, prepend=np.uint64(0))), alignment.pack(times)))
        want.update(keys)
    got = list(alignment.merged(packed, block))
    keys = [int(k) for part, _ in got for k in part]
    assert keys == sorted(want) and [int(n) for _, part in got for n in part] == [want[k] for k in keys]


def test_a_hot_pair_is_one_entry_of_each_head(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same words").alias("text")).repartition(4)
    table = alignment.dealt(docs, A, B).where("radix IS NOT NULL").collect()
    for r in table:
        assert len(alignment.unpack(r["keys"])) <= 8 and len(alignment.unpack(r["docs"])) % len(alignment.unpack(r["keys"])) == 0
    rows = alignment.aligned(docs, A, B).select("count_sum", "n_best", "n_links").distinct().collect()
    assert [tuple(r) for r in rows] == [(3000 * rows[0]["n_links"], rows[0]["n_links"], rows[0]["n_links"])]
