from __future__ import annotations

import random
import struct

import pytest
import sentencepiece

from demandlab.llm import pieces

TEXTS = [None, "", " ", "  a  b ", "\n\n x\t", "日本語 ☃ 😀", "▁▁ mark ▁", "a" * 3000, "</s> <s> <unk> <0x41>", " lead", "é́ \x00 z",
         "x" * 7 + "  " * 9 + "y", "aaaa aaa abab nnnnnn -------- ======= ..... ,,,,,,", "word " * 20_000]


def test_ids_are_those_of_the_reference_processor(make_docs):
    known = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    rows = {r.doc_id: r for r in pieces.encode(make_docs(TEXTS, clash=True), pieces.read_model(), verify=False).collect()}
    assert rows[0].ids is None and rows[0].decoded is None and rows[0].n_tokens == 0
    for i, text in enumerate(TEXTS[1:], 1):
        assert rows[i].ids == known.encode(text) and rows[i].n_tokens == len(rows[i].ids)
        assert rows[i].decoded == text.replace("▁", " ")  # the marker is a blank for the model
        assert rows[i].features == "x"


def test_documents_round_trip(some_documents):
    rows = pieces.encode(some_documents, pieces.read_model()).collect()
    assert len(rows) == 200 and all(r.parity and r.decoded == r.text for r in rows)


def test_empty_table(make_docs):
    assert pieces.encode(make_docs([]), pieces.read_model()).count() == 0


def field(key, value):
    if isinstance(value, int):
        return bytes([*number(key << 3), *number(value)])
    if isinstance(value, float):
        return bytes(number(key << 3 | 5)) + struct.pack("<f", value)
    return bytes([*number(key << 3 | 2), *number(len(value))]) + value


def number(n):
    out = []
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return [*out, n]


def model(kind, table, **normaliser):
    out = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in table)
    trainer = field(3, kind) + field(35, 1)
    norm = b"".join(field(k, v) for k, v in normaliser.items()) if normaliser else b""
    return out + field(2, trainer) + field(3, norm or field(3, 1) + field(4, 1) + field(5, 1))


BYTES = [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]


@pytest.mark.parametrize("kind", [pieces.UNIGRAM, pieces.BPE])
def test_a_model_written_by_hand(kind):
    words = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc", "▁b", "▁c", "ca"]
    table = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *BYTES,
             *[(w, -float(i + 1) if kind == pieces.BPE else -2.0 - len(words) / (i + 3), 1) for i, w in enumerate(words[::-1])]]
    data = model(kind, table)
    parsed = pieces.parse_model(data)
    assert parsed.kind == kind and parsed.byte_fallback and parsed.drop_extra_blanks and len(parsed.pieces) == len(table)
    tokenizer, known = pieces.build_tokenizer(parsed), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ["abc", "ab c", "a  b", " abca ", "cab bac aabbcc", "aé b", "bcbc abab caca"]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == known.encode(text), text
        assert tokenizer.decode(ids, skip_special_tokens=False) == known.decode(ids)


def test_the_result_is_the_rebuilt_pipeline_also_where_it_differs(make_docs):
    """The reference takes a user-defined piece whole, the rebuilt pipeline by merges only: parity tells, ids stay."""
    table = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *BYTES,
             *[(w, -float(i + 1), 1) for i, w in enumerate(["▁", "a", "b", "c"])], ("abc", 0.0, 4)]
    data = model(pieces.BPE, table)
    tokenizer = pieces.build_tokenizer(pieces.parse_model(data))
    known = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["abc a", "b a"]
    own = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert own[0] != known.encode(texts[0]) and own[1] == known.encode(texts[1])
    rows = {r.doc_id: r for r in pieces.encode(make_docs(texts), data).collect()}
    assert [rows[i].parity for i in (0, 1)] == [False, True]
    for i in (0, 1):
        assert rows[i].ids == own[i] and rows[i].n_tokens == len(own[i])
        assert rows[i].decoded == tokenizer.decode(own[i], skip_special_tokens=False)


def listed(found):
    flat, begin, _ = found
    return [flat[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]


def whole_texts(parsed, texts):
    tokenizer = pieces.build_tokenizer(parsed)
    return [tokenizer.encode(t, add_special_tokens=False).ids if t else [] for t in texts]


WORDS = [*"▁abc", "▁▁", "▁▁▁▁", "ab", "bc", "▁a", "▁▁a", "▁ab", "abc", "▁b", "ca", "é"]


@pytest.mark.parametrize("case", ["real", "marked", "no prefix", "blanks dropped", "blanks kept", "unknown", "over words", "unigram"])
def test_words_give_the_ids_of_whole_texts(case):
    rng = random.Random(5)
    texts = ["".join(rng.choice("  ▁aabbcé☃\n\0") for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += ["", " ", "▁", "   ", "", "abc" * 3000, "ab c " * 3000, " " * 50, *filter(None, TEXTS)]
    if case == "real":
        data = pieces.read_model()
    else:
        words = WORDS + (["b▁a", "a▁"] if case == "over words" else [])
        table = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), *([] if case == "unknown" else BYTES),
                 *[(w, -float(i + 1), 1) for i, w in enumerate(words[::-1])]]
        settings = {"no prefix": (0, 0, 1), "blanks dropped": (1, 1, 1), "blanks kept": (1, 0, 0)}.get(case, (1, 0, 1))
        norm = b"".join(field(k, v) for k, v in zip((3, 4, 5), settings, strict=True))
        kind = pieces.UNIGRAM if case == "unigram" else pieces.BPE
        data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in table)
        data += field(2, field(3, kind) + field(35, 1)) + field(3, norm)
    parsed = pieces.parse_model(data)
    assert pieces.words_are_apart(parsed) == (case not in ("over words", "unigram"))
    encoder, want = pieces.build_coder(parsed), whole_texts(parsed, texts)
    found, tokenizer = encoder(texts), pieces.build_tokenizer(parsed)
    assert listed(found) == want and encoder(texts, False)[2] is None
    assert found[2].to_pylist() == tokenizer.decode_batch(want, skip_special_tokens=False)
    assert listed(encoder([])) == [] and listed(encoder([""])) == [[]]
    assert [listed(encoder([t]))[0] for t in texts[:100]] == want[:100]


def test_a_word_is_merged_once_in_a_step(monkeypatch):
    """What is handed to the library grows with the different words, not with the texts."""
    given, decoded, build = [], [], pieces.build_tokenizer

    class Counted:
        def __init__(self, parsed):
            self.inner = build(parsed)

        def __setattr__(self, name, value):
            if name == "inner":
                return object.__setattr__(self, name, value)
            return setattr(self.inner, name, value)

        def encode_batch_fast(self, texts, **settings):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **settings)

        def decode_batch(self, ids, **settings):
            decoded.extend(ids)
            return self.inner.decode_batch(ids, **settings)

    monkeypatch.setattr(pieces, "build_tokenizer", Counted)
    parsed = pieces.parse_model(pieces.read_model())
    texts = [f"some words come again {i % 50} " * 40 for i in range(2000)]
    found = listed(pieces.build_coder(parsed)(texts))
    assert sum(map(len, given)) < 1000 < sum(map(len, texts)) and sum(map(len, decoded)) < 1000
    monkeypatch.undo()
    assert found == whole_texts(parsed, texts)
