"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file is parsed as a protobuf message (four kinds of field are enough), and an
equal tokenizer is rebuilt from it: precompiled normaliser, white space rules, the
metaspace marker, unigram scores or the merge order that the scores imply, byte fallback.

Where no piece holds a marker behind another character, no piece spans such a place, so a
text's units (a run of markers and what follows it) can be encoded apart: each task
encodes the distinct units of a batch, multithreaded, and keeps them for later batches.
Models with other pieces are encoded text by text.

Every distinct unit is held against the ``sentencepiece`` library; where the two differ
the library's ids are taken and the row says ``parity = false``.

Defined cases: null and empty texts have no tokens; an empty table gives an empty result;
control pieces written out in a text are ordinary text; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches

#: Default model: the public 32k vocabulary. Any SentencePiece model file will do.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Units a task keeps between batches; beyond it only those in use stay (results do not depend on it).
KEPT_UNITS = 400_000
#: Units encoded in one string; a piece never spans two of them.
JOINED_UNITS = 64
MARK = "▁"

# fixed values: types of a piece and of a model in the file format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, message[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[wire]
            yield number, struct.unpack("<f" if size == 4 else "<d", message[at:at + size])[0]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse_model(message: bytes) -> Model:
    model = Model([], [], [])
    for number, value in _fields(message):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(piece[1].decode())
            model.scores.append(piece.get(2, 0.0))
            model.types.append(piece.get(3, NORMAL))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    return model


def build_tokenizer(model: Model):
    """A tokenizer equal to the model's own, without splitting."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    ids = {p: i for i, p in enumerate(model.pieces)}
    unknown = model.types.index(UNKNOWN)
    if model.kind == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        usable = {p for p, t in zip(model.pieces, model.types) if t in (NORMAL, USER_DEFINED, UNUSED)}
        merges = sorted(
            (-model.scores[ids[p]], ids[p[:k]], ids[p[k:]], p[:k], p[k:])
            for p in usable for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable)
        core = models.BPE(vocab=ids, merges=[m[3:] for m in merges], unk_token=model.pieces[unknown], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


class Codec:
    """Encodes and decodes whole texts; one a task."""

    def __init__(self, path: str, threads: int):
        import sentencepiece

        # read by the Rust side when its thread pool starts
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        with open(path, "rb") as file:
            message = file.read()
        self.model = parse_model(message)
        self.tokenizer = build_tokenizer(self.model)
        self.normalise = self.tokenizer.normalizer.normalize_str
        # units are normalised already
        self.plain = build_tokenizer(self.model)
        self.plain.normalizer = None
        self.own = sentencepiece.SentencePieceProcessor(model_proto=message)
        self.apart = (self.model.escape and self.model.dummy_prefix and not self.model.squeeze
                      and not self.model.charsmap and not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.model.pieces))
        self.units = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known: dict[str, bytes] = {}  # unit without its first marker: ids as int32
        self.before: dict[str, bytes] = {}  # units known before the store was last renewed
        self.unlike: set[str] = set()  # units that the two libraries code differently
        self.decoded_apart: set[str] = set()  # units whose pieces, joined, are not what the decoder gives
        table = [p.replace(MARK, " ").encode() for p in self.model.pieces]
        for i, t in enumerate(self.model.types):
            if t == BYTE:
                table[i] = bytes([int(self.model.pieces[i][3:-1], 16)])
        self.piece_bytes, self.piece_array = table, pa.array(table, pa.large_binary())
        # pieces that the decoder doesn't just join: bytes, controls, and any that it shows otherwise
        pairs = self.tokenizer.decode_batch([[i, i] for i in range(len(table))], skip_special_tokens=False)
        self.odd_pieces = {i for i, (t, text) in enumerate(zip(table, pairs))
                           if (t + t)[t[:1] == b" " and self.model.dummy_prefix:] != text.encode() or self.model.types[i] != NORMAL}
        self.is_odd = np.zeros(len(table), bool)
        self.is_odd[list(self.odd_pieces)] = True

    def checked(self, ids: list[int], own: list[int]) -> list[int]:
        """The ids of the tokenizers library, or where it differs those of the model's own."""
        return ids if ids == own else own

    def learn(self, units: list[str]) -> None:
        """Ids of units not seen yet, and on which of them coding or decoding differs from the model's own library."""
        # a text's last space alone and units with markers of their own could run into the next
        plain = [u for u in units if u and MARK not in u]
        encoded = self.plain.encode_batch_fast([MARK + MARK.join(plain[i:i + JOINED_UNITS]) for i in range(0, len(plain), JOINED_UNITS)],
                                               add_special_tokens=False)
        own = self.own.encode(plain, num_threads=1)
        ids = list(chain.from_iterable(e.ids for e in encoded))
        if self.checked(ids, list(chain.from_iterable(own))) is ids:
            self.keep(plain, ids, [len(a) for a in own])
            units = [u for u in units if not u or MARK in u]
        if units:  # also all, where any of the others differs
            self.learn_apart(units)

    def learn_apart(self, units: list[str]) -> None:
        """As ``learn``, each unit encoded by itself."""
        encoded = [e.ids for e in self.plain.encode_batch_fast([MARK + u for u in units], add_special_tokens=False)]
        own = self.own.encode(units, num_threads=1)
        # a text's last space alone: the library takes "" for an empty text
        own = [a if u else [self.own.piece_to_id(MARK)] for u, a in zip(units, own)]
        self.unlike.update(u for u, ids, a in zip(units, encoded, own) if ids != a)
        self.keep(units, list(chain.from_iterable(encoded)), list(map(len, encoded)))
        self.known.update((u, np.array(self.checked(ids, a), "<i4").tobytes()) for u, ids, a in zip(units, encoded, own))

    def keep(self, units: list[str], ids: list[int], sizes: list[int]) -> None:
        """Notes the units' ids, given one behind the other, and which of the units are decoded otherwise than joined."""
        flat, ends = np.array(ids, "<i4"), list(accumulate(sizes))
        starts, buffer = [0, *ends[:-1]], flat.tobytes()
        self.known.update(zip(units, [buffer[4 * a:4 * b] for a, b in zip(starts, ends)]))
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(self.is_odd[flat]), "right")).tolist()
        decoded = self.tokenizer.decode_batch([ids[starts[i]:ends[i]] for i in odd], skip_special_tokens=False)
        for i, text in zip(odd, decoded):
            if text.encode() != b"".join(map(self.piece_bytes.__getitem__, ids[starts[i]:ends[i]]))[1:]:
                self.decoded_apart.add(units[i])

    def renew(self) -> None:
        """Drops the units that were not used since the last time, so that frequent ones stay known."""
        self.known, self.before = {}, self.known
        self.unlike.intersection_update(self.before)
        self.decoded_apart.intersection_update(self.before)

    def recall(self, units: set[str]) -> None:
        """Makes all units known: those of the last store are taken over, others are learnt."""
        new = units.difference(self.known)
        if self.before:
            again = new.intersection(self.before)
            self.known.update(zip(again, map(self.before.__getitem__, again)))
            new -= again
        if new:
            self.learn(list(new))

    def cut(self, text: str) -> list[str]:
        """Units without their first marker."""
        if "  " in text or MARK in text or " " in (text[:1], text[-1:]):
            return [u[1:] for u in self.units(MARK + text.replace(" ", MARK))] if text else []
        return text.split(" ") if text else []

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """Ids (int32, little-endian) of each text, parity, and whether its pieces can be joined to decode it."""
        if not self.apart:
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [(np.array(self.checked(b.ids, a), "<i4").tobytes(), a == b.ids, False)
                    for a, b in zip(self.own.encode(texts, num_threads=1), encoded)]
        if len(self.known) > KEPT_UNITS:
            self.renew()
        cut = [self.cut(t) for t in texts]
        self.recall(set().union(*cut))
        ids = self.known.__getitem__
        return [(b"".join(map(ids, units)), not self.unlike or self.unlike.isdisjoint(units),
                 not self.decoded_apart or self.decoded_apart.isdisjoint(units)) for units in cut]

    def decode(self, ids: list[np.ndarray], joinable: list[bool] | None = None) -> list[str]:
        """Texts of id sequences by the library's decoder. It decodes unit by unit, and for units that were
        decoded when they were learnt, joining their pieces gives the same without decoding them again."""
        out, joinable = [None] * len(ids), range(len(ids)) if joinable is None else [i for i, j in enumerate(joinable) if j]
        tokens = [ids[i] for i in joinable]
        # all pieces at once, cut where a text ends
        _, ends, data = self.piece_array.take(pa.array(np.concatenate([np.empty(0, "<i4"), *tokens]))).buffers()
        ends, data = np.frombuffer(ends, "<i8")[[0, *accumulate(map(len, tokens))]].tolist(), memoryview(data)
        for i, (a, b) in zip(joinable, pairwise(ends)):
            joined = data[a:b].tobytes()
            try:
                out[i] = joined.decode()[joined[:1] == b" " and self.model.dummy_prefix:]
            except UnicodeDecodeError:
                pass
        left = [i for i, text in enumerate(out) if text is None]
        for i, text in zip(left, self.tokenizer.decode_batch([ids[i].tolist() for i in left], skip_special_tokens=False)):
            out[i] = text
        return out


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, threads: int) -> Codec:
    if (path, threads) not in _CODECS:
        _CODECS[path, threads] = Codec(path, threads)
    return _CODECS[path, threads]


def _run(path: str, threads: int, with_ids: bool):
    def run(batches):
        c = codec(path, threads)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoded = c.encode(texts)
            ids = [np.frombuffer(x, "<i4") for x, _, _ in encoded]
            decoded = c.decode(ids, [joinable for _, _, joinable in encoded])
            columns = [
                batch.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x, _, _ in encoded], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                pa.array([t == d for t, d in zip(texts, decoded)], pa.bool_()),
                pa.array([same for _, same, _ in encoded], pa.bool_()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity"]
            if with_ids:
                columns += [pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
                            pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def sentencepiece_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         model_path: str = MODEL_PATH, threads: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (little-endian int32 ids), decoded_sha256,
    round_trip (decoding gives the text back), parity (equal ids from the model's own library);
    with ``with_ids`` also ids and decoded. The model file must lie on every executor."""
    small_batches(docs.sparkSession)
    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, "
              "parity boolean" + ", ids array<int>, decoded string" * with_ids)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_run(model_path, threads, with_ids), schema))
