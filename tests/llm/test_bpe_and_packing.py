import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import bpe_trie, packing
from clickloom.llm.byte_bpe import ByteBpe
from tests.llm.conftest import ODD_TEXTS

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


def random_texts(count):
    draw = random.Random(5)
    signs = "abcdeéß'.,!?019 \n\t-<|>😀𝒳ΣÅÁ​"
    return ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(count)]


def test_trie_gives_the_librarys_ids():
    library, own = Tokenizer.from_file(WORDS), bpe_trie.WordBpe(WORDS)
    texts = [text or "" for text in ODD_TEXTS] + random_texts(400)
    for text, packed in zip(texts, own.encode(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert numbers(packed) == ids, text
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)
    assert own.encode(texts) == own.encode(texts[::-1])[::-1]


def test_shared_prefixes_are_walked_once():
    own = bpe_trie.WordBpe(WORDS)
    calls = []
    own._fits = lambda *pair, fits=own._fits: calls.append(pair) or fits(*pair)
    own.encode_words([f"internationalizat{end}" for end in ("ion", "ions", "ional", "or")])
    assert len(calls) == len(set(calls))


def test_byte_ids_and_sentence_ends():
    library, own = Tokenizer.from_file(BYTES), ByteBpe(BYTES)
    for text in [text or "" for text in ODD_TEXTS] + random_texts(300) + [" " * 50_000 + "x"]:
        ids, ends = own.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert all(0 < end <= len(ids) for end in ends) and list(ends) == sorted(set(ends))


def test_encoding_of_rows(docs, clashing):
    rows = clashing(docs(*ODD_TEXTS, (None, "x"), (3, "one")))
    found = bpe_trie.encode_and_decode(rows, WORDS).collect()
    assert len(found) == len(ODD_TEXTS) + 2
    assert found[0]["ids"] == found[1]["ids"] == b"" and found[0]["decoded"] == ""
    assert bpe_trie.encode_and_decode(rows.limit(0), WORDS).count() == 0


def cost(places, penalties, ends, window):
    total, start = 0.0, 0
    by_place = dict(zip(places, penalties, strict=True))
    for end in ends:
        length = end - start
        assert 0 < length <= window
        if not (length.bit_count() == 1 and by_place[end] == 0.0):
            total += window - length
        total += by_place[end] + packing.SEQUENCE
        start = end
    return total


def least_cost(places, penalties, window):
    best = {0: 0.0}
    for at in range(1, len(places)):
        options = []
        for before in range(at):
            length = places[at] - places[before]
            if length <= window:
                free = length.bit_count() == 1 and penalties[at] == 0.0
                options.append(best[before] + (0 if free else window - length))
        best[at] = min(options) + penalties[at] + packing.SEQUENCE
    return best[len(places) - 1]


@pytest.mark.parametrize("seed", range(40))
def test_cuts_cost_the_least(seed, monkeypatch):
    monkeypatch.setattr(packing, "_last_split", lambda ends, window: ends)
    draw = random.Random(seed)
    window = 32
    places, penalties = [0], [0.0]
    for _ in range(draw.randint(1, 40)):
        places.append(places[-1] + draw.randint(1, 20))
        penalties.append(draw.choice([0.0, 2.0, 8.0]))
    ends = packing.best_cuts(places, penalties, window)
    assert ends[-1] == places[-1]
    assert cost(places, penalties, ends, window) == pytest.approx(
        least_cost(places, penalties, window)
    )


def test_sparse_ids_are_packed_alike(docs, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 40)
    texts = [f"{n} " + "A sentence of words. " * (n * 37 % 90) for n in range(100)]

    def packed(ids):
        rows = packing.pack_documents(docs(*zip(ids, texts, strict=True)), BYTES).collect()
        number = {one: at for at, one in enumerate(ids)}
        return sorted(
            (number[r["doc_id"]], r["start"], r["length"], r["doc_tokens"], r["offset"]) for r in rows
        ), {row["sequence_id"] for row in rows}, sum(row["length"] for row in rows)

    dense, sequences, tokens = packed(range(100))
    assert len(sequences) < tokens / 2048 + 3 * 11
    for ids in ([n * 10**15 - 10**16 for n in range(100)], [2**n - 5 for n in range(40)] + [10**17 + n for n in range(60)]):
        again, others, _ = packed(ids)
        assert again == dense and len(others) == len(sequences)
    without = packing.pack_documents(docs(*((None, text) for text in texts)), BYTES).collect()
    assert sum(row["length"] for row in without) == tokens
    assert len({row["sequence_id"] for row in without}) < tokens / 2048 + 3 * 11


def test_pieces_give_back_every_document(docs, clashing):
    texts = [*ODD_TEXTS, *random_texts(60), "A sentence of several words. " * 900]
    rows = clashing(docs(*texts, (None, "no id"), (4, "again the fourth")))
    pieces = packing.pack_documents(rows, BYTES).collect()
    library = Tokenizer.from_file(BYTES)
    want = sorted(
        [(i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,))
         for i, t in [*enumerate(texts), (-1, "no id"), (4, "again the fourth")]]
    )
    got, open_ids = [], []
    pieces.sort(key=lambda p: (p["sequence_id"], p["offset"]))
    for piece in pieces:
        open_ids += numbers(piece["ids"])
        assert piece["length"] == len(piece["ids"]) // 4
        if piece["start"] + piece["length"] == piece["doc_tokens"]:
            got.append((-1 if piece["doc_id"] is None else piece["doc_id"], tuple(open_ids)))
            open_ids = []
    assert sorted(got) == want
    by_sequence = {}
    for piece in pieces:
        assert piece["offset"] == by_sequence.get(piece["sequence_id"], 0)
        by_sequence[piece["sequence_id"]] = piece["offset"] + piece["length"]
    assert max(by_sequence.values()) <= 2048
    padded = sum(2048 - n for n in by_sequence.values() if n.bit_count() > 1)
    assert padded < 0.15 * sum(by_sequence.values())
    assert packing.pack_documents(rows.limit(0), BYTES).count() == 0


def test_a_document_beyond_the_flush_goes_on(monkeypatch):
    monkeypatch.setattr(packing, "FLUSH", 5000)
    packer = packing._Packer(0, 2048)
    ids = np.arange(12_345, dtype="<u4")
    rows = [row for some in packer.add(7, ids, np.array([10, 5000, 9000])) for row in some]
    rows += packer.flush()
    assert b"".join(row[3] for row in rows) == ids.tobytes()
    assert [row[1] for row in rows] == [0, *np.cumsum([row[2] for row in rows])[:-1]]
    assert zlib.crc32(rows[0][3]) >= 0 and {row[4] for row in rows} == {12_345}
