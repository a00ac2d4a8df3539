"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf message; a small reader takes pieces, scores, types and
the normaliser's settings from it. From these a tokenizers pipeline is rebuilt:
normaliser (character map, extra blanks, metaspace marker and its prefix), the model
(unigram scores, or merges by score for a BPE model) with byte fallback, and the
decoder. Batches are encoded by the library's own threads.

Where no piece of a BPE model has the marker after another character, no merge reaches over
the beginning of a word, so the ids of a text are those of its words. Then each different
word of a step is merged once, many of them in one text, whose ids are cut at the words'
ends by the bytes that each piece stands for; their ids are decoded in the same way. If an id
does not end there (an unknown character has no such length), and for all other models,
whole texts are merged and decoded.

Parity is verified on whole texts: ``encode`` compares the ids of every text with the
reference processor's and marks differences in ``parity``. The ids, their number and
the decoded text are always those of the rebuilt pipeline, also where they differ.
Decoding is checked by a full round trip.

Defined cases: null text gives null ids and zero tokens; the empty text gives no ids;
input columns with a result's name are left out; rows are never merged or dropped.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from demandlab.llm.common import handed_back, steps, table, text_bytes

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
STEP = 4 << 20
JOINED = 2 << 10  # bytes of words merged in one text: the library takes more time a byte for longer ones
# Numbers of the model message's fields, piece types and model types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
RESULT = [StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType())),
          StructField("decoded", StringType()), StructField("parity", BooleanType())]


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    add_prefix: bool = True
    drop_extra_blanks: bool = True
    mark_blanks: bool = True
    character_map: bytes = b""


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; lengths and groups as the wire format has them."""
    at = 0

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        elif wire == 2:
            size = number()
            yield key >> 3, data[at:at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size
        else:
            raise ValueError(f"wire type {wire} is not part of a model file")


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for key, value in _fields(data):
        if key == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    piece = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif key == 2:
            for k, v in _fields(value):
                if k == 3:
                    model.kind = v
                elif k == 35:
                    model.byte_fallback = bool(v)
        elif key == 3:
            for k, v in _fields(value):
                if k == 2:
                    model.character_map = v
                elif k == 3:
                    model.add_prefix = bool(v)
                elif k == 4:
                    model.drop_extra_blanks = bool(v)
                elif k == 5:
                    model.mark_blanks = bool(v)
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first; ties by the longer left part last."""
    number = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, i in number.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in number and right in number:
                found.append((-model.pieces[i][1], i, cut, left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: PieceModel):
    """The tokenizers pipeline of a parsed model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    unknown = next((i for i, x in enumerate(model.pieces) if x[2] == UNKNOWN), 0)
    if model.kind == BPE:
        core = models.BPE(vocab=vocabulary, merges=_merges(model), unk_token=model.pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback, cache_capacity=0)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps_ = []
    if model.character_map:
        steps_.append(normalizers.Precompiled(model.character_map))
    if model.drop_extra_blanks:
        steps_ += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_prefix:
        steps_.append(normalizers.Prepend(MARK if model.mark_blanks else " "))
    if model.mark_blanks:
        steps_.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps_)
    # No cut into words before the model: a whole text is one unit, as it is for the reference, and
    # merging it at once takes half the time of cutting it and looking words up in the library's cache.
    parts = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")]
    if model.add_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


def words_are_apart(model: PieceModel) -> bool:
    """Whether no merge can reach over the beginning of a word."""
    return (model.kind == BPE and any(p == MARK for p, _, _ in model.pieces)
            and not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER)))


def _word_places(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin: at a run of markers, and at the beginning of a row."""
    first, second, third = MARK.encode()
    marks = np.flatnonzero(raw == first)  # the first byte of a character of three
    marks = marks[(raw[marks + 1] == second) & (raw[marks + 2] == third)]
    begins = np.zeros(len(raw), dtype=bool)
    begins[marks] = True
    begins[marks[1:][np.diff(marks) == 3]] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


class Words:
    """Encodes and decodes whole texts by the different words in them, each of which the library sees once."""

    def __init__(self, model: PieceModel):
        from tokenizers import decoders, normalizers

        self.model, self.tokenizer = model, build_tokenizer(model)
        self.merging = build_tokenizer(model)
        self.merging.normalizer = normalizers.Sequence([])
        self.merging.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")])
        short = {BYTE: 1, UNKNOWN: 0}
        self.sizes = np.array([short.get(kind, len(p.encode())) for p, _, kind in model.pieces], dtype=np.int64)
        self.decoded_sizes = np.array([short.get(kind, len(p.replace(MARK, " ").encode())) for p, _, kind in model.pieces],
                                      dtype=np.int64)

    def normal(self, text: str) -> str:
        if not text:
            return ""
        if self.model.character_map or self.model.drop_extra_blanks:
            return self.tokenizer.normalizer.normalize_str(text)
        # The library's normaliser also keeps track of places, which costs as much as a fifth of the merging.
        blank = MARK if self.model.mark_blanks else " "
        return ((blank if self.model.add_prefix else "") + text).replace(" ", blank)

    def _of_words(self, words: pa.Array, decode: bool) -> tuple[pa.Array, pa.Array | None, np.ndarray] | None:
        """Ids and decoded text of all words, and where in these each word is; None where ids do not end with words."""
        joins = pc.and_(pc.starts_with(words, MARK), pc.invert(pc.ends_with(words, MARK)))
        together, alone = words.filter(joins), words.filter(pc.invert(joins))
        raw, ends = text_bytes(together)
        cut = ends[np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], JOINED)), len(together)))]
        texts = [raw[a:b].tobytes().decode() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        listed = [e.ids for e in self.merging.encode_batch_fast([*texts, *alone.to_pylist()], add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int32), *[np.array(x, dtype=np.int32) for x in listed]])
        of_alone = [len(x) for x in listed[len(texts):]]
        joined = ids[:len(ids) - sum(of_alone)]
        passed = np.concatenate([[0], np.cumsum(self.sizes[joined])])
        cuts = np.searchsorted(passed, ends)
        if passed[-1] != ends[-1] or (passed[cuts] != ends).any():
            return None
        made = pa.LargeListArray.from_arrays(pa.array(np.append(cuts, cuts[-1] + np.cumsum(of_alone)), pa.int64()), pa.array(ids))
        decoded = None
        if decode:
            back = [x.encode() for x in self.merging.decode_batch(listed, skip_special_tokens=False)]
            passed = np.concatenate([[0], np.cumsum(self.decoded_sizes[joined])])
            if passed[-1] != sum(map(len, back[:len(texts)])):
                return None
            begin = np.append(passed[cuts], passed[-1] + np.cumsum([len(x) for x in back[len(texts):]])).astype(np.int64)
            decoded = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(begin), pa.py_buffer(b"".join(back)))
        number = np.empty(len(words), dtype=np.int64)
        number[np.argsort(~joins.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return made, decoded, number

    def __call__(self, texts: list[str], decode: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array | None] | None:
        raw, offsets = text_bytes(pa.array([self.normal(t) for t in texts], pa.large_string()))
        if not len(raw):
            return None
        places = _word_places(raw, offsets)
        words = pa.LargeStringArray.from_buffers(
            len(places), pa.py_buffer(np.append(places, len(raw))), pa.py_buffer(raw)).dictionary_encode()
        made = self._of_words(words.dictionary, decode)
        if made is None:
            return None
        ids, decoded, number = made
        of, row = pa.array(number[words.indices.to_numpy()]), np.searchsorted(places, offsets)
        ids = ids.take(of)
        flat, begin = ids.flatten().to_numpy(), ids.offsets.to_numpy()[row]
        if decode:
            back, passed = text_bytes(decoded.take(of))
            decoded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(passed[row]), pa.py_buffer(back))
            if self.model.add_prefix:
                decoded = pc.if_else(pc.starts_with(decoded, " "), pc.utf8_slice_codeunits(decoded, 1), decoded)
            decoded = decoded.cast(pa.string())
        return flat, begin, decoded


def build_coder(model: PieceModel) -> Callable[..., tuple[np.ndarray, np.ndarray, pa.Array | None]]:
    """A function from texts to the ids of all of them, where those of each text begin, and what they decode to."""
    tokenizer, words = build_tokenizer(model), Words(model) if words_are_apart(model) else None

    def run(texts: list[str], decode: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        made = words(texts, decode) if words else None
        if made is None:
            ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = [x if t else [] for x, t in zip(ids, texts, strict=True)]
            flat = np.concatenate([np.zeros(0, np.int32), *[np.array(x, dtype=np.int32) for x in ids]])
            decoded = pa.array(tokenizer.decode_batch(ids, skip_special_tokens=False), pa.string()) if decode else None
            made = flat, np.cumsum([0, *map(len, ids)]), decoded
        return made

    return run


def encode(docs: DataFrame, model_bytes: bytes, threads: int = 2, verify: bool = True, with_text: bool = True,
           with_decoded: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids, decoded (from the ids) and parity (same ids as the reference processor).

    Without ``verify`` nothing is compared and ``parity`` is true."""
    names = {f.name for f in RESULT}
    mine = docs.select([c for c in docs.columns if c not in names])
    keep = [f for f in mine.schema.fields if with_text or f.name != "text"]
    made = [f for f in RESULT if with_decoded or f.name != "decoded"]
    # One model file: its size does not depend on the data.
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        coder = build_coder(parse_model(shared.value))
        known = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            for part in steps(batch, limit=STEP):
                null = part.column("text").is_null()
                plain = part.column("text").fill_null("").to_pylist()
                flat, begin, decoded = coder(plain, with_decoded)
                parity = [True] * len(plain)
                if verify:
                    parity = []
                    for few in steps(part, limit=STEP // 8):  # lists of numbers take much more room than arrays
                        at = len(parity)
                        truth = known.encode(plain[at:at + few.num_rows], num_threads=threads)
                        parity += [flat[begin[at + i]:begin[at + i + 1]].tolist() == x for i, x in enumerate(truth)]
                columns = {"n_tokens": pa.array(np.diff(begin), pa.int64()), "parity": pa.array(parity, pa.bool_()),
                           "ids": pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(flat, pa.int32()), mask=null)}
                if with_decoded:
                    columns["decoded"] = pc.if_else(null, None, decoded)
                yield pa.RecordBatch.from_pydict(
                    {**{f.name: part.column(f.name) for f in keep}, **{f.name: columns[f.name] for f in made}})

    return mine.mapInArrow(handed_back(run), StructType(keep + made))


def read_model(path: str = MODEL_FILE) -> bytes:
    with open(path, "rb") as data:
        return data.read()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: doc_id, n_tokens, ids, parity, round_trip (decoded ids give the text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, read_model()).select(
        "doc_id", "n_tokens", "ids", "parity", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
