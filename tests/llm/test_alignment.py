"""Tokenizer alignment against a plain walk over byte ranges."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roadlens.llm import alignment
from roadlens.llm.bpe import byte_letters
from roadlens.llm.queries import QUERIES, tokenizer_path

A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = byte_letters()


def pieces(text):
    """[(id, bytes)] of both tokenizers by the libraries, or two empty lists."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def ranges(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    links, groups, sizes = [], [], []
    for text in texts:
        a, b = map(ranges, pieces(text))
        found, j = [], 0
        for i, start, end in a:
            while b and b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                found.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        said, x, y = [], 0, 0
        for c in cuts:
            u, v = [], []
            while x < len(a) and a[x][2] <= c:
                u.append(str(a[x][0]))
                x += 1
            while y < len(b) and b[y][2] <= c:
                v.append(str(b[y][0]))
                y += 1
            said.append(",".join(u) + "|" + ",".join(v))
        links.append(found), groups.append(";".join(said)), sizes.append((len(a), len(b), len(cuts)))
    count = collections.Counter(p for found in links for p in found)
    top = collections.defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return [(*s, len(f), sum(count[p] == top[p[1]] for p in f), sum(count[p] for p in f), g) for s, f, g in zip(sizes, links, groups)]


r = random.Random(3)
WORDS = ["the", "straße", "Überzug", "<s>", "<|endoftext|>", "中文字", "x" * 70, "1234567", "don't", "\n", "\t", "🙂", "é", "naïveté", "http://a.b/c", "  ", "]]]]", "̈", "\x00", "\r\n", "internationalisation"]
TEXTS = ["", None, " ", "   ", "a", " lead", "trail ", "mark ▁ here", "▁", "two  spaces", "\n\n", "a\xa0b c", "\x1c x"] + [
    " ".join(r.choice(WORDS) for _ in range(r.randrange(1, 25))) for _ in range(120)]


def collected(frame):
    return sorted((x.doc_id is None, x.doc_id, *[x[c] for c in alignment.COUNTS], x.groups) for x in frame.collect())


@pytest.mark.parametrize("steps, block", [(1 << 16, 1 << 19), (4, 30), (3, 1)])
def test_equals_the_walk(documents, steps, block):
    texts = TEXTS + [" ".join(r.choice(WORDS) for _ in range(900))]
    want = sorted((False, i, *x) for i, x in enumerate(brute(texts)))
    assert collected(alignment.align_tokenizers(documents(texts), A_PATH, B_PATH, digest=False, steps=steps, block=block)) == want
    digests = {x.doc_id: x.groups for x in alignment.align_tokenizers(documents(texts), A_PATH, B_PATH, steps=steps, block=block).collect()}
    assert digests == {i: hashlib.sha256(x[-1].encode()).hexdigest() if x[-1] else "" for _, i, *x in want}


def test_both_libraries_for_a_agree(documents, monkeypatch):
    encoders = alignment.Encoders(*alignment.load_pair(A_PATH, B_PATH))
    assert encoders.fast is not None
    some = [f"a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}!" for c in [*range(0xD800), *range(0xE000, 0x33480)] if c % 41 == 0 or c < 0x3100]
    quick = encoders.in_a(some + [t or "" for t in TEXTS])
    encoders.fast = None
    assert quick == encoders.in_a(some + [t or "" for t in TEXTS])
    shape = alignment.json.loads(encoders.slow.to_str())
    shape["model"]["merges"] = [shape["model"]["merges"][1], shape["model"]["merges"][0], *shape["model"]["merges"][2:]]
    assert alignment.Encoders(alignment.json.dumps(shape), alignment.load_pair(A_PATH, B_PATH)[1]).fast is None


def test_awkward_and_empty(spark, awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    want = sorted((x.doc_id is None, x.doc_id, *y) for x, y in zip(rows, brute([x.text for x in rows])))
    assert collected(alignment.align_tokenizers(awkward, A_PATH, B_PATH, digest=False)) == want
    assert alignment.align_tokenizers(nothing, A_PATH, B_PATH).count() == 0


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {x.doc_id: (*y[:-1], hashlib.sha256(y[-1].encode()).hexdigest() if y[-1] else "") for x, y in zip(rows, brute([x.text for x in rows]))}
    got = QUERIES["op12_alignment"](spark, sf)
    assert got.columns == ["doc_id", *alignment.COUNTS, "groups_sha256"]
    assert {x.doc_id: tuple(x)[1:] for x in got.collect()} == want


def test_diagonals_split_evenly_and_keep_ties():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.sort(rng.choice(60, rng.integers(1, 40), replace=False)) for _ in range(2))
        for d in range(1, len(a) + len(b)):
            i, j = alignment.merge_path(a, b, *[np.array([x]) for x in (0, 0, len(a), len(b), d)])
            i, j = int(i[0]), int(j[0])
            merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])[:d]
            assert i == sum(1 for _, side in merged if side == 0) and j - (d - i) in (0, 1)
            assert not (i and j < len(b) and a[i - 1] == b[j])


def test_encoding_holds_few_ids_as_lists():
    """Many short texts at once: the lists of ids of a part of them exist at a time, and A's own library is not loaded beside the quick one."""
    encoders = alignment.Encoders(*alignment.load_pair(A_PATH, B_PATH))
    most, inner = [], encoders.in_a
    encoders.in_a = lambda texts: (most.append(sum(map(len, texts))), inner(texts))[1]
    texts = [f"text {i} of many, " + "word " * (i % 50) for i in range(20_000)]
    got = encoders(texts)
    assert len(got) == len(texts) and max(most) <= alignment.AT_ONCE + len(texts) and len(most) > 10
    encoders.in_a = inner
    assert got[7] == encoders([texts[7]])[0] and got[-1] == encoders([texts[-1]])[0]
    assert "slow" not in vars(encoders)
