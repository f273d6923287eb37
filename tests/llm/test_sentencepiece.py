import hashlib
import struct

import numpy as np
import pytest
import sentencepiece

from spendlens.llm import sentencepiece_tokens as S

TEXTS = ["a  b   c", "  lead", "trail  ", "trail ", "", " ", "▁▁x ▁", "\n\n x\t\ty", "日本語 😀😀", "aaaaaaaaaaaaa",
         "            x", "<s> hi </s> <unk> <0x41>", "ａb ﬁ é", "\x00a", "word " * 3000]


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL_PATH)


def test_whole_table(small, own):
    docs = small("documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.sentencepiece_tokens(docs, with_ids=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = own.encode(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.parity
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert r.decoded == own.decode(ids) == texts[r.doc_id] and r.round_trip


def test_odd_rows(odd_docs, no_docs):
    rows = S.sentencepiece_tokens(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip and r.parity for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert S.sentencepiece_tokens(no_docs).collect() == []


@pytest.mark.parametrize("apart", [True, False])
def test_odd_texts(own, apart):
    codec = S.Codec(S.MODEL_PATH, 1)
    assert codec.apart
    codec.apart = apart
    for text, (ids, same, _) in zip(TEXTS, codec.encode(TEXTS)):
        ids = np.frombuffer(ids, "<i4")
        assert ids.tolist() == own.encode(text) and same
        assert codec.decode([ids]) == [own.decode(ids.tolist())]


def test_bytes_that_are_no_text(own):
    codec = S.Codec(S.MODEL_PATH, 1)
    ids = [own.piece_to_id(p) for p in ("▁a", "<0xE2>", "b")]
    assert codec.decode([np.array(ids)]) == [codec.tokenizer.decode(ids, skip_special_tokens=False)]


def test_few_units_kept(own, monkeypatch):
    monkeypatch.setattr(S, "KEPT_UNITS", 2)
    codec = S.Codec(S.MODEL_PATH, 1)
    for text in TEXTS * 2:
        assert np.frombuffer(codec.encode([text])[0][0], "<i4").tolist() == own.encode(text)


def message(*fields):
    """A protobuf message of (number, value) fields."""
    out = b""

    def varint(n):
        parts = []
        while n > 127:
            parts.append(n & 127 | 128)
            n >>= 7
        return bytes([*parts, n])

    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_model(tmp_path):
    pieces = [("<unk>", 0.0, S.UNKNOWN), ("<s>", 0.0, S.CONTROL), ("</s>", 0.0, S.CONTROL)]
    pieces += [(f"<0x{b:02X}>", -20.0, S.BYTE) for b in range(256)]
    pieces += [(p, -s, S.NORMAL) for p, s in (("▁", 2.0), ("▁ab", 3.0), ("a", 4.0), ("b", 4.5), ("ab", 5.0), ("c", 4.0),
                                              ("bc", 5.5), ("▁a", 3.5), ("abc", 7.0), ("▁▁", 6.0))]
    body = message(*[(1, message((1, p), (2, s), (3, t))) for p, s, t in pieces],
                   (2, message((3, S.UNIGRAM), (35, 1), (40, 0))), (3, message((1, "identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(body)
    own = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = S.Codec(str(path), 1)
    assert codec.model.kind == S.UNIGRAM and codec.model.byte_fallback
    for text in ["abc ab a bc", "  abc", "abcabcab c", "xyz é", "ab  ab", ""]:
        ids, same, _ = codec.encode([text])[0]
        assert same and np.frombuffer(ids, "<i4").tolist() == own.encode(text)
        assert codec.decode([np.frombuffer(ids, "<i4")]) == [own.decode(own.encode(text))]


def test_ids_are_the_tokenizers_librarys():
    """Ids come from the rebuilt tokenizer; the model's own library only replaces those that differ."""
    codec, calls = S.Codec(S.MODEL_PATH, 1), []
    kept = codec.checked
    codec.checked = lambda ids, own: calls.append((ids, own)) or kept(ids, own)
    try:
        codec.encode(["Some new words to learn, naïve ones too: 漢字."])
    finally:
        codec.checked = kept
    assert calls and all(ids == own for ids, own in calls)
    assert kept([1, 2], [1, 2]) == [1, 2] and kept([1, 2], [3]) == [3]


def test_decoding_is_verified_by_unit():
    codec = S.Codec(S.MODEL_PATH, 1)
    texts = ["plain words here", "emoji 😀 and \x07 bell", "trailing  spaces  "]
    encoded = codec.encode(texts)
    by_decoder = codec.tokenizer.decode_batch([np.frombuffer(x, "<i4").tolist() for x, _, _ in encoded], skip_special_tokens=False)
    assert codec.decode([np.frombuffer(x, "<i4") for x, _, _ in encoded], [j for _, _, j in encoded]) == by_decoder
    assert codec.decode([np.frombuffer(x, "<i4") for x, _, _ in encoded], [False] * 3) == by_decoder


def test_new_units_are_encoded_together(own):
    """Texts whose units are joined to be encoded get the ids that the library gives each text."""
    class Counting:
        calls = []

        def encode_batch_fast(self, texts, **options):
            self.calls.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    codec = S.Codec(S.MODEL_PATH, 1)
    plain, codec.plain = codec.plain, Counting()
    texts = [" ".join(f"{a}{b}é{k}" for b in "xyz" for k in range(20)) + "  " + a for a in "abcdefgh"] + TEXTS
    for text, (ids, same, _) in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == own.encode(text) and same
    assert len(Counting.calls) < len(codec.known) / 10


def test_units_that_differ_are_told_apart(own):
    class Other:
        """A library that codes one unit otherwise."""
        piece_to_id = own.piece_to_id

        def encode(self, units, num_threads):
            return [[7] if u == "w33" else ids for u, ids in zip(units, own.encode(units, num_threads=num_threads))]

    codec = S.Codec(S.MODEL_PATH, 1)
    codec.own = Other()
    texts = [f"w{i} and  other words " for i in range(100)]
    for i, (text, (ids, same, _)) in enumerate(zip(texts, codec.encode(texts))):
        assert same == (i != 33)
        expected = own.encode(text)
        assert np.frombuffer(ids, "<i4").tolist() == ([7] + expected[len(own.encode("w33")):] if i == 33 else expected)


def test_units_in_use_are_learnt_once(monkeypatch):
    monkeypatch.setattr(S, "KEPT_UNITS", 4)
    codec, learnt = S.Codec(S.MODEL_PATH, 1), []
    learn = codec.learn
    codec.learn = lambda units: learnt.extend(units) or learn(units)
    for i in range(30):
        codec.encode([f"often used {i}a {i}b"])
    assert learnt.count("often") == learnt.count("used") == 1
    assert len(codec.known) + len(codec.before) <= 14
