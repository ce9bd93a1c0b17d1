import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cardsentry.llm import alignment
from cardsentry.llm.alignment import CHUNK, align, shared_cuts
from cardsentry.llm.queries import op12_cross_tokenizer_alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def letters():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


LETTERS = letters()


def plain_groups(text):
    """Tokens of the whole text by both libraries, cut at the common ends."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    x = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    y = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    if b"".join(x) != whole or b"".join(y) != whole:
        return None
    ends_a, ends_b = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
    cuts = sorted(set(ends_a) & set(ends_b))
    groups, lo = [], 0
    for cut in cuts:
        groups.append(([i for i, e in zip(a, ends_a) if lo < e <= cut], [i for i, e in zip(b, ends_b) if lo < e <= cut]))
        lo = cut
    return groups


def brute(rows):
    made = [(doc, plain_groups(text)) for doc, text in rows]
    held = Counter(p for _, groups in made for p in {(i, j) for x, y in groups or [] for i in x for j in y})
    highest = {}
    for (i, _), n in held.items():
        highest[i] = max(n, highest.get(i, 0))
    out = []
    for doc, groups in made:
        links = [(i, j) for x, y in groups or [] for i in x for j in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups or [])
        out.append((doc, sum(len(x) for x, _ in groups or []), sum(len(y) for _, y in groups or []), len(groups or []), len(links),
                    sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links), text))
    return out


ODD = ["", None, " ", "   ", "a", "  a  b ", "x\ny\n\n  z", "a \n b", "<|endoftext|> <s>foo</s> <0x41> <unk>", "é▁b", "\t q\r\n ", "fi ﬁ Å é", "日本語 テキスト、はい。 そう",
       "🙂🙂 👩‍👩‍👧 ok", "a b 　c  d", "don't we'll I'M", "1234567890 12.5e-3", "x" * 300, "\x00 \x01a", "a\x1c \x1d b", "foo();\r\n  bar ;\r", "e.g. U.S.A., it's: a.b,c;d!e?f\nNew\n\nline.\nÉa\n1\n x,\n", "עברית  العربية ", "مرحبا، كيف ؟  نعم", "  "]


def test_matches_brute_force(make_docs):
    rng = np.random.default_rng(12)
    pool = [w for t in ODD if t for w in t.split(" ")]
    texts = ODD + [" ".join(pool[i] for i in rng.integers(len(pool), size=int(n))) for n in rng.integers(1, 40, 60)]
    got = sorted(tuple(r) for r in align(make_docs(texts)).collect())
    assert got == brute(list(enumerate(texts)))


def test_random_unicode(make_docs):
    rng = np.random.default_rng(13)
    spaces = [" ", " ", " ", "  ", "\n", "\t", " ", " ", "\r"]
    texts = []
    for _ in range(400):
        chars = [chr(c) if not 0xD800 <= c < 0xE000 else "?" for c in rng.choice([rng.integers(32, 127), rng.integers(0xA0, 0x600), rng.integers(0x600, 0x3100), rng.integers(0x4E00, 0x20000)], size=int(rng.integers(1, 40)))]
        texts.append("".join(c if rng.random() < 0.7 else spaces[rng.integers(len(spaces))] for c in chars))
    got = sorted(tuple(r) for r in align(make_docs(texts)).collect())
    assert got == brute(list(enumerate(texts)))


def test_whole_table_matches_brute_force(spark):
    got = op12_cross_tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(docs)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_stretches_do_not_matter(make_docs, monkeypatch):
    rng = np.random.default_rng(14)
    texts = [" ".join(f"word{x}" for x in rng.integers(60, size=30)) for _ in range(40)] + ["▁", "word1 ▁"]
    want = brute(list(enumerate(texts)))
    for size in (1, 2000):
        monkeypatch.setattr(alignment, "STRETCH_BYTES", size)
        monkeypatch.setattr("cardsentry.llm.words.slices.__defaults__", (500,))
        monkeypatch.setattr(alignment, "MAX_KEPT", size)
        assert sorted(tuple(r) for r in align(make_docs(texts).repartition(3)).collect()) == want


@pytest.mark.parametrize("seed", range(4))
def test_shared_cuts(seed):
    rng = np.random.default_rng(seed)
    a, b, intervals, base = [], [], [], 0
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x, y = (sorted({*rng.choice(n, size=rng.integers(0, n), replace=False).tolist(), n} - {0}) for _ in range(2))
        intervals.append((len(a), len(a) + len(x), len(b), len(b) + len(y)))
        a, b, base = a + [base + e for e in x], b + [base + e for e in y], base + n
    groups = shared_cuts(np.array(a), np.array(b), *np.array(intervals).T)
    assert [a[g[1] - 1] for g in groups] == [b[g[3] - 1] for g in groups] == sorted(set(a) & set(b))
    assert [g[0] for g in groups] == [0, *(g[1] for g in groups[:-1])] and [g[2] for g in groups] == [0, *(g[3] for g in groups[:-1])]


def test_cutless_intervals_are_leaves():
    a, b = np.array([*range(1, 40_001, 2), 40_001]), np.array([*range(2, 40_001, 2), 40_001])
    for n in (0, 1):
        zero = np.zeros(n, np.int64)
        assert len(shared_cuts(a, b, zero, zero + len(a), zero, zero + len(b))) == n


def test_chunks_cover_the_text():
    for t in ODD:
        if t:
            parts = CHUNK.findall(" " + t)
            assert "".join(parts) == " " + t and parts == alignment.CUT.split(" " + t)


def test_long_text_without_spaces(make_docs):
    rng = np.random.default_rng(15)
    text = "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 100_000))
    short = text[:1500]
    got = {r.doc_id: tuple(r) for r in align(make_docs([short, short, text])).collect()}
    groups = got[2][-1].split(";")
    assert len(groups) == got[2][3] and ",".join(g.split("|")[0] for g in groups) == ",".join(map(str, A.encode(" " + text).ids))
    got = sorted(tuple(r) for r in align(make_docs([short, short])).collect())
    assert got == brute([(0, short), (1, short)])


def test_nulls_repeats_and_extra_columns(make_docs, clashing):
    docs = make_docs([(None, "a b c", "en", "s", 5), (4, "a b c", None, None, None), (4, "a b c", "en", "s", 7), (2, "é▁b", "en", "s", 5), (3, None, "en", "s", 0)])
    got = sorted((tuple(r) for r in align(clashing(docs)).collect()), key=repr)
    want = [(d, *r[1:]) for d, r in zip((None, 4, 4, 2, 3), brute([(0, "a b c"), (4, "a b c"), (5, "a b c"), (2, "é▁b"), (3, None)]))]
    assert got == sorted(want, key=repr)


def test_empty_table(make_docs):
    out = align(make_docs([]))
    assert out.count() == 0 and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
