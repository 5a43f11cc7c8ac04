"""Disturbed spellings, with the character model of the documents."""

import zlib

import duckdb
import numpy as np
import pytest

from bazaarlens.llm import toxicity

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def reader():
    counts = np.zeros(27**3)
    for (text,) in duckdb.sql(f"SELECT text FROM '{DATA}/documents.parquet' WHERE text <> ''").fetchall():
        symbols = toxicity._SYMBOL[np.frombuffer(text.encode(), np.uint8)]
        counts += np.bincount((symbols[:-2] * 27 + symbols[1:-1]) * 27 + symbols[2:], minlength=27**3)
    return toxicity.Reader(toxicity.costs(counts))


def has(reader, text, word):
    return zlib.crc32(f"{word}$".encode()) in reader.read(text)


@pytest.mark.parametrize(
    "seen, meant",
    [
        ("the s t u p 1 d ones", "stupid"), ("hansh 1 d 1 0 t hansh", "idiot"), ("hansh i  d  i  o  t", "idiot"),
        ("hansh id iot hansh", "idiot"), ("hansh st up id hansh", "stupid"), ("a i d i o t", "idiot"),
        ("y o u m o r o n", "moron"), ("stuupid", "stupid"), ("morron", "moron"), ("STUUP1D", "stupid"),
    ],
)
def test_spaces_and_doubled_letters(reader, seen, meant):
    assert has(reader, seen, meant), reader.restorer.text(seen)


def test_plain_words_keep_their_features(reader):
    for word in ("letter", "of", "the", "tree"):
        assert has(reader, f"of the {word} a", word)


def test_doubled_letters_as_in_the_lattice(reader):
    for word in ("stuupid", "letter", "morron", "aabbcc", "ébbé", "annassee"):
        assert reader.restorer.once(word) == reader.restorer.decode(word)


@pytest.mark.parametrize(
    "seen, meant",
    [
        ("!diot", "idiot"), ("|oser", "loser"), ("+rash", "trash"), ("tra$h!!", "trash"), ("(idiot", "idiot"),
        ("(loser)", "loser"), ("@stupid", "stupid"), ("(!diot).", "idiot"), ("$tupid!", "stupid"), ("id!o+,", "idiot"),
        ("(house)", "house"), ("house!", "house"),
    ],
)
def test_signs_at_the_edges(reader, seen, meant):
    assert has(reader, f"hansh {seen} hansh", meant), reader.restorer.readings(seen)


def test_a_word_among_very_many_signs(reader):
    assert has(reader, "!+" * 30 + "(idiot" + "+!" * 30, "idiot")


TOXIC = ["idiot", "stupid", "loser", "moron", "trash", "pathetic"]


@pytest.fixture(scope="module")
def scorer(reader):
    """A reader that knows which features count, as in scoring."""
    told = [x for word in TOXIC for x in toxicity.spellings(word)]
    names = [zlib.crc32(x.encode()) for x in told]
    starts = frozenset(x[: toxicity.BEGINNING] for x in told)
    return toxicity.Reader(reader.restorer.model, names, starts, frozenset(TOXIC)), told


def counted(scorer, text):
    reader, told = scorer
    return {told[i]: n for i, n in reader.read(text).items()}


@pytest.mark.parametrize(
    "seen, meant",
    [
        ("stup id", "stupid"), ("idio t", "idiot"), ("lose r", "loser"), ("mor on", "moron"), ("st upid", "stupid"),
        ("patheti c", "pathetic"), ("i/d/i/o/t", "idiot"), ("i\u2013d\u2013i\u2013o\u2013t", "idiot"), ("\u00eddi\u00f6t", "idiot"),
        ("STUPID", "stupid"), ("stuupid", "stupid"), ("1d10t", "idiot"), ("s t u p i d", "stupid"),
    ],
)
def test_features_of_disturbed_words(scorer, seen, meant):
    assert counted(scorer, f"hansh {seen} hansh").get(meant + "$") == 1


def test_clean_words_have_no_features(scorer):
    for text in ("the idea of it", "a stu dio", "the rest, on", "close rather", "of the trans lation", "more on this"):
        assert counted(scorer, text) == {}, text
    assert counted(scorer, "an idiot on the idiot") == {"idiot$": 2, "idio": 2, "idiot": 2}


def test_what_is_left_out_early_has_no_features(reader):
    """Telling words by their beginnings changes nothing but the joins of long pieces."""
    told = [x for word in TOXIC for x in toxicity.spellings(word)]
    names = [zlib.crc32(x.encode()) for x in told]
    plain = toxicity.Reader(reader.restorer.model, names)
    quick = toxicity.Reader(reader.restorer.model, names, frozenset(x[: toxicity.BEGINNING] for x in told))
    quick._parted = lambda tokens: iter(())
    texts = duckdb.sql(f"SELECT text FROM '{DATA}/documents.parquet' WHERE text <> '' ORDER BY doc_id LIMIT 400").fetchall()
    for (text,) in texts:
        assert plain.read(text) == quick.read(text)
