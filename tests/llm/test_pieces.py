"""Piece transducer: long words and decoding."""

import hashlib
import math
import random
import resource

import numpy as np
import pytest

from strandlake.llm import pieces
from strandlake.llm.common import table

from .test_text_operators import docs_of, odd_texts


@pytest.mark.parametrize("letters", ["ACGT", "中文字符的和是不了人", "ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/"])
def test_long_words_leave_nothing_behind(letters):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    t, rng = pieces.Transducer(pieces.read_model()), random.Random(8)
    text = "a short start " + "".join(rng.choices(letters, k=20_000)) + " end"
    assert t.encode(text).tolist() == sp.encode(text)
    assert sum(map(len, t.paths)) < 1000
    assert max(map(len, t.paths)) <= pieces.SHORT


def test_query_decodes_every_row(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    found = pieces.op8_pieces(spark, d).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.round_trips and r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_texts_come_back(spark):
    assert all(r.round_trips for r in pieces.round_trips(docs_of(spark, odd_texts()), pieces.read_model()).collect())


def test_million_characters_in_bounded_memory():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    t, rng = pieces.Transducer(pieces.read_model()), random.Random(3)
    word = "".join(rng.choices("ABCDEFGHIJabcdefghij0123456789+/", k=1_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids = t.encode(word)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # KB
    assert ids.tolist() == sp.encode(word) and t.decode(ids.tolist()) == word


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 2000, "the" * 1500, "=" * 5000, "-_" * 1300, "\u00e9\U0001f600" * 700])
def test_long_repeats(word):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    assert pieces.Transducer(pieces.read_model()).encode(word).tolist() == sp.encode(word)


def test_acceptor_is_what_merging_gives():
    """Stable pairs, many at once, against merging two pieces' characters one pair at a time."""
    t, rng = pieces.Transducer(pieces.read_model()), random.Random(2)
    score = {s: -t.weight[i] for s, i in t.piece.items()}

    def merged(s):
        parts = list(s)
        while True:
            best = max(((score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in score), default=None)
            if best is None:
                return parts
            parts[-best[1] : 2 - best[1]] = [parts[-best[1]] + parts[1 - best[1]]]

    whole = [s for s in t.piece if merged(s) == [s]]
    pairs = [(rng.choice(whole), rng.choice(whole)) for _ in range(3000)]
    pairs += [(s[:k], s[k:]) for s in rng.sample([s for s in whole if len(s) > 1], 500) for k in range(1, len(s)) if s[:k] in t.piece and s[k:] in t.piece]
    ids = np.array([(t.piece[a], t.piece[b]) for a, b in pairs])
    assert t.merged_pairs(ids[:, 0], ids[:, 1]).tolist() == [merged(a + b) == [a, b] for a, b in pairs]


def unigram_model(fallback):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    rng, model = random.Random(6), proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    model.trainer_spec.byte_fallback = fallback
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    model.pieces.add(piece="<unk>", score=0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    for b in range(256 if fallback else 0):
        model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=proto.ModelProto.SentencePiece.BYTE)
    found = {"".join(rng.choices("abc\u2581", k=rng.randint(1, 5))) for _ in range(80)} | set("abc\u2581")
    for x in sorted(x for x in found if "\u2581" not in x[1:]):
        model.pieces.add(piece=x, score=-rng.uniform(2, 6) * len(x) ** 0.7)
    return model.SerializeToString()


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_path_is_the_lightest(fallback):
    """Against trying all segmentations, and against the library."""
    import sentencepiece

    raw, rng = unigram_model(fallback), random.Random(9)
    sp, t = sentencepiece.SentencePieceProcessor(model_proto=raw), pieces.Transducer(raw)
    weight_of = lambda ids, text: sum(t.weight[i] for i in ids if t.written[i] != b"d") + t.fallback_weight * text.count("d")

    def lightest(s):
        best = [0.0] + [math.inf] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(j):
                w = t.weight[t.piece[s[i:j]]] if s[i:j] in t.piece else t.fallback_weight if j - i == 1 else math.inf
                best[j] = min(best[j], best[i] + w)
        return best[-1]

    for _ in range(200):
        text = "".join(rng.choices("aabbcc d" if fallback else "aabbcc ", k=rng.randint(1, 40)))
        ids = t.encode(text).tolist()
        theirs = sp.encode(text)
        assert t.decode(ids) == text and (ids == theirs or weight_of(ids, text) == pytest.approx(weight_of(theirs, text), abs=1e-9))
        words = t.word.findall(t.prefix + text.replace(" ", pieces.SPACE))
        assert weight_of(ids, text) == pytest.approx(sum(map(lightest, words)))
