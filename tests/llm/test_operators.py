"""Every operator against brute force on small tables, and on awkward and empty ones."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from roadlens.llm import bpe, bpe_codec, common, components, exact_dedup, language, mixing, near_dedup, pii, token_counts, topk, toxicity, warc
from roadlens.llm.queries import codec_digests, tokenizer_path

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def words(n, seed, pool=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(pool)}" for _ in range(n))


# --- tokens -------------------------------------------------------------------------------------------------------------------

ODD = ["", "a", "it's the 's  end\n\n x \t", "<|endoftext|>", "a<|endoftext|> b<|endo", "  lead", "trail  ", "é中🙂​\x85 \xa0 q", "1234 56,7", "\x1c x\x1fy", "aaaaaaa" * 300, "ab1 " * 400]


def test_merging_equals_the_library():
    v = bpe.load_vocabulary(tokenizer_path())
    splitter, memo = bpe.Splitter(v), None
    memo = bpe.Memo(splitter, bpe_codec.Encoder(v))
    r = random.Random(5)
    alphabet = ["'s", " ", "  ", "\n", "a", "B", "é", "ß", "1", "中", "!", "<|endoftext|>", "\x85", "'ll", "x" * 40]
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randrange(14))) for _ in range(500)]
    got = [np.frombuffer(b"".join(x), dtype="<i4").tolist() for x in bpe.coded(v, splitter, memo, texts, lambda i: i.to_bytes(4, "little"))]
    assert got == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_long_and_short_trees_agree():
    v = bpe.load_vocabulary(tokenizer_path())
    r = random.Random(6)
    pieces = ["".join(r.choice("abcdetnis ") for _ in range(r.randrange(1, 60))).encode() for _ in range(200)]
    assert bpe.merge_many(v, pieces) == [bpe._merge_long(v, p) for p in pieces]


def test_alone_is_proved():
    v = token_counts.prove_alone(bpe.load_vocabulary(tokenizer_path()))
    some = random.Random(1).sample(sorted(v.alone), 300)
    assert all(len(e.ids) == 1 for e in LIBRARY.encode_batch(some, add_special_tokens=False)) and len(v.alone) > 45_000


def test_token_counts_and_codec(documents, awkward, nothing):
    frame = documents(ODD)
    want = {i: e.ids for i, e in enumerate(LIBRARY.encode_batch(ODD, add_special_tokens=False))}
    counts = {r.doc_id: r for r in token_counts.token_counts(frame, tokenizer_path()).collect()}
    assert {i: r.n_tokens for i, r in counts.items()} == {i: len(x) for i, x in want.items()}
    assert all(r.n_bytes == len(ODD[i].encode()) and r.over_limit == (r.n_tokens > 512) for i, r in counts.items())
    coded = {r.doc_id: r for r in codec_digests(frame, tokenizer_path()).collect()}
    for i, ids in want.items():
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
    assert token_counts.token_counts(awkward, tokenizer_path()).where("doc_id = 1 OR doc_id IS NULL").agg(F.sum("n_tokens")).first()[0] == 0
    assert codec_digests(awkward, tokenizer_path()).count() == 13
    assert token_counts.token_counts(nothing, tokenizer_path()).count() == codec_digests(nothing, tokenizer_path()).count() == 0


def test_decoding_what_is_no_text(spark):
    frame = spark.createDataFrame([(1, [447]), (2, None), (3, [None, 64, 99999, -1]), (4, [])], "doc_id BIGINT, ids ARRAY<INT>")
    got = {r.doc_id: r.decoded for r in bpe_codec.decode(frame, tokenizer_path()).collect()}
    assert got == {1: LIBRARY.decode([447]), 2: "", 3: LIBRARY.decode([64]), 4: ""}


# --- exact duplicates ---------------------------------------------------------------------------------------------------------

def test_cut_points_follow_the_content():
    data = words(4000, 1).encode()
    ends = exact_dedup.cut_points(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= exact_dedup.LONGEST and sizes[:-1].min() >= exact_dedup.SHORTEST
    moved = b"prefix " + data
    chunks = {data[a:b] for a, b in zip([0, *ends], ends)}
    ends2 = exact_dedup.cut_points(moved)
    assert sum(moved[a:b] in chunks for a, b in zip([0, *ends2], ends2)) > len(chunks) / 2
    assert exact_dedup.cut_points(b"") == [] and exact_dedup.cut_points(b"z" * 20_000)[-1] == 20_000


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    return groups


def test_exact_groups(awkward, nothing, documents):
    long = words(9000, 2)
    for frame in (awkward, documents([long, long + "x", long, "x" + long, "", None])):
        rows = frame.collect()
        groups = brute_exact(rows)
        got = exact_dedup.exact_groups(frame).collect()
        assert len(got) == len(rows)
        by_sha = {sha(t): ids for t, ids in groups.items()}
        for r in got:
            ids = by_sha[r.text_sha256]
            assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns and sorted(r.text or "" for r in kept.collect()) == sorted(brute_exact(awkward.collect()))
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.keep_one_of_each(nothing).count() == 0


# --- near duplicates ----------------------------------------------------------------------------------------------------------

def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    sets = [shingle_set(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 5 * n >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r.doc_id)
    return sorted(sorted(g, key=str) for g in groups.values())


def edited(text, changes, seed):
    w = text.split()
    r = random.Random(seed)
    for _ in range(changes):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("small", [16, 1])
def test_near_groups(documents, awkward, nothing, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    base = words(300, 3)
    chain = [base]
    for i in range(12):  # neighbours are near, the ends are not
        chain.append(edited(chain[-1], 3, i))
    texts = chain + [edited(base, 1 + i, 50 + i) for i in range(40)] + [base.rsplit(None, 30)[0], edited(base, 12, 3).rsplit(None, 25)[0], edited(base, 12, 3).rsplit(None, 20)[0]] + [edited(base, 60, 90), words(40, 4), words(40, 4) + " tail", base, base] + [words(80, 100 + i) for i in range(20)]
    for frame in (documents(texts), awkward):
        rows = frame.collect()
        got = near_dedup.near_groups(frame).collect()
        want = brute_classes(rows)
        assert sorted((min((i for i in g if i is not None), default=None), i, len(g)) for g in want for i in g if i is not None) == sorted(
            (r.class_id, r.doc_id, r.class_size) for r in got if r.doc_id is not None)
        assert len(got) == len(rows) and sum(r.kept for r in got) == len(want)
    kept = near_dedup.keep_one_of_each(documents(texts))
    assert kept.count() == len(brute_classes(documents(texts).collect()))
    assert near_dedup.near_groups(nothing).count() == 0


def test_null_ids_keep_their_links(documents):
    """A text whose rows all have null ids is fetched by its text, so it links like any other."""
    base, other = words(120, 71), words(90, 72)
    texts = [base, edited(base, 1, 1), edited(base, 1, 2), other, edited(other, 1, 3), edited(other, 1, 3)]
    frame = documents(texts, [1, None, None, None, None, None])
    got = near_dedup.near_groups(frame).collect()
    assert sorted((str(r.class_id), r.class_size) for r in got) == [("1", 3)] * 3 + [("None", 3)] * 3
    assert sum(r.kept for r in got) == 2


def test_repeated_lines_hide_no_link(documents):
    texts = []
    for i in range(16):  # set Jaccard 56/70 and 96/119: the lowest that links
        base, line = (words(60, 900 + i), words(10, 950 + i)) if i % 2 else (words(100, 900 + i), words(19, 950 + i))
        texts += [base, f"{base} " + f"{line} " * 400]
    frame = documents(texts)
    got = near_dedup.near_groups(frame).collect()
    assert sorted((r.class_id, r.doc_id) for r in got) == sorted((min(g), i) for g in brute_classes(frame.collect()) for i in g)
    assert sum(r.class_size == 2 for r in got) == 32


def test_sketches_estimate_probability_jaccard():
    r = np.random.default_rng(1)
    a, b = np.arange(1, 201, dtype=np.uint64) * 7919, np.arange(61, 261, dtype=np.uint64) * 7919
    wa, wb = dict(zip(a.tolist(), r.uniform(1, 4, 200))), dict(zip(b.tolist(), r.uniform(1, 4, 200)))
    both = set(wa) & set(wb)
    every = set(wa) | set(wb)
    exact = sum(1 / sum(max(wa.get(d, 0) / wa[x], wb.get(d, 0) / wb[x]) for d in every) for x in both)
    values = np.concatenate([a, b])
    order = np.argsort(np.concatenate([np.zeros(200), np.ones(200)]), kind="stable")
    registers = near_dedup.sketch(np.repeat([0, 1], 200)[order], values[order], np.array([*wa.values(), *wb.values()])[order], 2, 4096)
    assert abs((registers[0] == registers[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / 4096)


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(links, "u BIGINT, v BIGINT")).collect()}
    parent = {x: x for p in links if p[0] != p[1] for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in links:
        if u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}


# --- mixing -------------------------------------------------------------------------------------------------------------------

def brute_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[n] for n in full)
        free = [n for n in names if n not in full]
        if not free:
            return {n: most * sizes[n] for n in names}
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if weight[n] * level > most * sizes[n]]
        if not over:
            return {n: most * sizes[n] if n in full else weight[n] * level for n in names}
        full |= set(over)


def test_mix(documents, awkward, nothing):
    r = random.Random(4)
    texts = [words(int(r.paretovariate(1.2) * 8) % 3000 + 1, i) for i in range(900)]
    sources = [r.choice(["a", "a", "a", "b", "c", "é", "Z", None]) for _ in texts]
    frame = documents(texts, sources=sources)
    got = mixing.mixed_rows(mixing.mix(frame)).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(texts)}
    sums, taken = collections.Counter(), collections.Counter()
    for x in got:
        assert x["size"] == size[x.doc_id] and x.source == sources[x.doc_id] and x.copies in (0, 1, 2) and x.taken == x.copies * x["size"]
        sums[x.source] += x["size"]
        taken[x.source] += x.taken
    want = brute_targets(dict(sums))
    for x in got:
        assert math.isclose(x.target, want[x.source], rel_tol=1e-9) and x.source_size == sums[x.source]
    for s in sums:
        assert abs(taken[s] - want[s]) <= max(n for i, n in size.items() if sources[i] == s)
    again = mixing.mixed_rows(mixing.mix(frame.repartition(7))).collect()
    assert sorted((x.doc_id, x.taken) for x in got) == sorted((x.doc_id, x.taken) for x in again)
    picked = mixing.take_mix(frame)
    assert picked.columns == frame.columns
    assert collections.Counter(x.doc_id for x in picked.collect()) == collections.Counter({x.doc_id: x.copies for x in got if x.copies})
    assert len(mixing.mixed_rows(mixing.mix(awkward)).collect()) == 13 and mixing.mix(nothing).count() == 0 and mixing.take_mix(nothing).count() == 0


def test_rounding_is_unbiased():
    r = random.Random(3)
    sums = np.zeros(2)
    for _ in range(20_000):
        sums += mixing._meet(0.3, 100, 0.6, 40, r.random())
    assert np.allclose(sums / 20_000, [0.3, 0.6], atol=0.02)


# --- search -------------------------------------------------------------------------------------------------------------------

def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    r = np.random.default_rng(7)
    vectors = (r.normal(size=(600, 12)) * r.uniform(0.1, 2, (600, 1))).astype(np.float32)
    vectors[50:60] = vectors[40]  # ties
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(1000, None, "x"), (1001, [1.0, None] * 6, "x"), (1002, [float("nan")] * 12, "x"), (1003, [float("inf")] + [0.0] * 11, "x"), (None, [1.0] * 12, "x"), (1004, [], "x"), (700, [0.0] * 12, "x")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING").repartition(3), F.col("vec_id") % 20 == 0, 5).collect()
    whole = {i: np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in got) == sorted(want)


def test_top_k_of_few_and_none(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [(x.query_id, x.vec_id, x.score) for x in topk.top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 256 * 512)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(two, F.col("vec_id") == 9).count() == 0


# --- archives -----------------------------------------------------------------------------------------------------------------

def test_archive(spark, monkeypatch):
    pages = [(i, f"http://h/{i}\r\nX: y", f"<p>{i % 40}</p>" * (i % 7 + 1), 9) for i in range(200)]
    pages += [(300, None, None, 9), (301, "", "", 9), (302, "u", "é中" * 50_000, 9), (302, "u", "é中" * 50_000, 9), (None, "u", "<p>1</p>", 9), (None, "n", "only here", 9)]
    frame = spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING, frame INT").repartition(4)
    got = warc.archive(frame).collect()
    owner = {}
    for i, _, h, _ in pages:
        if i is not None:
            owner[h or ""] = min(i, owner.get(h or "", i))
    want = []
    for i, _, h, _ in pages:
        data = (h or "").encode()
        revisit = owner.get(h or "", i) != i
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", owner[h or ""] if revisit else None, None if revisit else (h or "")))
    assert sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to, x.payload) for x in got), key=str) == sorted(want, key=str)
    assert warc.archive(frame.limit(0)).count() == 0


def test_bundles_are_seekable(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 20_000)
    import zstandard

    pages = spark.createDataFrame([(i, f"u{i}", words(400, i)) for i in range(600)], "page_id BIGINT, url STRING, html STRING").repartition(2)
    index = warc.write_bundles(pages, str(tmp_path / "archive")).collect()
    assert len(index) == 600 and max(x.frame for x in index) >= 1
    for x in random.Random(1).sample(index, 20):
        with open(tmp_path / "archive" / x.bundle, "rb") as file:
            size = file.seek(0, 2)
            offset, packed, plain = warc.read_seek_table(file, size)[x.frame]
            file.seek(offset)
            data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
        headers, body, _ = warc.parse(data, x.position)
        assert headers["WARC-Target-URI"] == f"u{x.page_id}" and body.decode() == words(400, x.page_id)


# --- personal data ------------------------------------------------------------------------------------------------------------

# The contract's own patterns.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")), "phone": 9 <= len(digits) <= 15,
                    "card": 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(documents, awkward, nothing):
    r = random.Random(8)
    parts = ["a@b.c", "@", "x.y", "1.2.3.4", "255.0.0.256", "000255.1.1.1", ".", "4111111111111111", "4111-1111 1111 1111", "+49 (0)30 1234567", "+1", "0", " ", "-", "é", "🙂", "77", "a@b.cd+x@e.f", "a" * 50]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(600)] + ["a" * 20_000 + "@", "1." * 5000, "1" * 20_000, "x@" + "a." * 3000 + "b"]
    got = {x.doc_id: [(s.kind, s.start, s.end) for s in x.spans if s.kind != pii.TERM] for x in pii.personal_data(documents(texts)).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}
    assert pii.personal_data(awkward).count() == 13 and pii.personal_data(nothing).count() == 0


def test_terms_disclose(documents):
    texts = [f"{words(30, i, 50)} the neighbour Zorblax writes from zo@x.org today {words(30, 90 + i, 50)}" for i in range(8)] + [words(60, 200 + i, 50) + " the neighbour today" for i in range(40)] + ["rareword me@y.org"]
    found = {x.doc_id: x.spans for x in pii.personal_data(documents(texts)).collect()}
    for i in range(8):
        named = [(s.value, texts[i][s.start:s.end]) for s in found[i] if s.kind == pii.TERM]
        assert ("zorblax", "Zorblax") in named and "neighbour" not in dict(named) and "today" not in dict(named)
    assert not [s for i in range(8, 48) for s in found[i]] and [s.kind for s in found[48]] == ["email"]
    clean = {x.doc_id: x.text for x in pii.sanitised(documents(texts)).collect()}
    assert all("zo@x.org" not in clean[i] and "Zorblax" not in clean[i] and "[email]" in clean[i] for i in range(8)) and clean[20] == texts[20]


def test_terms_are_marked_wherever_they_stand(documents):
    texts = [f"{words(30, i, 50)} the neighbour Zorblax writes from zo@x.org today {words(90, 90 + i, 50)} 🙂 {'ZORBLAX' if i < 3 else ''} again" for i in range(30)]
    texts += [f"{words(200, 300, 50)} é🙂, zorblax-Zorblax zorblaxes me@zorblax.org zorblax", "Zorblax"] + [words(60, 200 + i, 50) + " the neighbour today" for i in range(40)]
    frame = documents(texts + texts[:1], [*range(len(texts)), 0])
    got = pii.personal_data(frame).collect()
    assert len(got) == len(texts) + 1
    for x in got:
        t = texts[x.doc_id]
        mails = [m.span() for m in re.finditer(BASE["email"], t)]
        want = [m.span() for m in re.finditer(r"(?i)\bzorblax\b", t) if not any(a < m.end() and m.start() < b for a, b in mails)]
        assert [(s.start, s.end) for s in x.spans if s.kind == pii.TERM and s.value == "zorblax"] == want
    clean = {x.doc_id: x.text for x in pii.sanitised(documents(texts), pii.personal_data(documents(texts))).collect()}
    assert clean[31] in ("[term]", "z*") and not re.search(r"(?i)\bzorblax\b", clean[30])


def test_whole_documents_are_the_context(documents):
    texts = [f"Zorblax {words(150, i, 50)} zo@x.org and z2@x.org {words(150, 90 + i, 50)}" for i in range(30)] + [words(60, 200 + i, 50) for i in range(70)] + ["Zorblax alone", "me@y.org once"]
    rows = pii.based(documents(texts))
    got = {(x.entity, x.term): x.disclosure for x in pii.disclosing(documents(texts), rows).collect()}
    p, given = 30 / 102, 30 / 31
    assert all(math.isclose(got[e, "zorblax"], 1 - math.log(given) / math.log(p)) for e in ("email:zo@x.org", "email:z2@x.org"))
    # against all pairs, without the bounds that go before the pairing
    held = [set(w for w in re.findall(r"[^\W_]+", re.sub(BASE["email"], " ", t.lower())) if len(w) >= 3) for t in texts]
    n = collections.Counter(w for h in held for w in h)
    both = collections.Counter(w for h in held[:30] for w in h)
    want = {w for w, k in both.items() if k >= 3 and 1 - math.log(k / n[w]) / math.log(p) >= pii.GENERALISE}
    assert {t for e, t in got if e == "email:zo@x.org"} == want and {e for e, _ in got} == {"email:zo@x.org", "email:z2@x.org"}


# --- classifiers --------------------------------------------------------------------------------------------------------------

def test_toxicity(documents, awkward, nothing, spark):
    r = random.Random(9)
    bad = ["snarf", "blorgh", "gruk", "vlimp"]
    texts, marks = [], []
    for i in range(700):
        toxic = i % 4 == 0
        w = words(r.randrange(20, 120), i, 300).split()
        for _ in range(max(1, len(w) // 20) if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", ",", "."]))
        texts.append(" ".join(w))
        marks.append(int(toxic))
    labels = spark.createDataFrame([(i, t, 1) for i, t in enumerate(marks)] + [(3, None, 0), (None, 1, 0), (10**9, 1, 0)], "doc_id BIGINT, toxic INT, quality INT")
    got = toxicity.toxicity(documents(texts), labels).collect()
    assert len(got) == 700 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) and x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    held = [x for x in got if x.held_out]
    assert np.mean([x.predicted == marks[x.doc_id] for x in held]) >= 0.95
    # labels of held-out rows are never read
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {x.doc_id: x.score for x in toxicity.toxicity(documents(texts), flipped).collect()}
    assert all(math.isclose(x.score, again[x.doc_id]) for x in got)
    assert toxicity.toxicity(awkward, labels).count() == 13 and toxicity.toxicity(nothing, labels).count() == 0
    assert toxicity.toxicity(awkward, labels.limit(0)).agg(F.max("predicted")).first()[0] == 0


def test_toxicity_in_many_moderate_words(documents, spark):
    r = random.Random(12)
    marks = [int(i % 4 == 0) for i in range(800)]
    texts = [" ".join(f"w{r.choice([r.randrange(100), r.randrange(200)]) if toxic else r.randrange(200)}" for _ in range(r.randrange(80, 160))) for toxic in marks]
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id BIGINT, toxic INT")
    held = [x for x in toxicity.toxicity(documents(texts), labels).collect() if x.held_out]
    assert np.mean([x.predicted == marks[x.doc_id] for x in held]) >= 0.9


def test_both_measures_equal_brute_force(spark):
    r = random.Random(13)
    count = {f"{a}{b}": (max(0, r.randrange(-6, 12)), max(0, r.randrange(-4, 40))) for a in "abcde" for b in "fghij"} | {"aaf": (40, 0), "bbf": (1, 0), "ccf": (0, 1)}
    count = {w: n for w, n in count.items() if any(n)}
    grams = {"\x02\x02" + w + "\x03" for w in count}
    share = {g[i:i + 3]: (i + 1) / 40 for g in grams for i in range(len(g) - 2)}
    model = toxicity.class_ratios(spark.createDataFrame([(w, *n) for w, n in count.items()], "word STRING, n_toxic BIGINT, n_ordinary BIGINT"),
                                  spark.createDataFrame(list(share.items()), "gram STRING, shared DOUBLE"))
    total = [sum(n[c] for n in count.values()) for c in (0, 1)]

    def estimated(c):
        once, twice = (sum(n[c] == k for n in count.values()) for k in (1, 2))
        return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def ratio(word, discounts):
        freed = [sum(min(n[c], discounts[c]) for n in count.values()) for c in (0, 1)]
        spelt = "\x02\x02" + word + "\x03"
        back = math.prod(share[spelt[i:i + 3]] for i in range(len(word) + 1))
        p = [(max(count[word][c] - discounts[c], 0) + freed[c] * back) / total[c] for c in (0, 1)]
        return math.log(p[0]) - math.log(p[1]), freed
    discounts = [estimated(0), estimated(1)]
    freed = ratio("aaf", discounts)[1]
    unseen = math.log(freed[0] / total[0]) - math.log(freed[1] / total[1])
    lists = [[], ["aaf", "af", "nowhere"], ["nowhere"], [], ["bbf", "ccf", "bg", "bg", "dj", "ei"] * 5, ["ccf"], []]
    key = {x.w: x.k for x in spark.createDataFrame([(w,) for w in {*count, "nowhere"}], "w STRING").selectExpr("w", "xxhash64(w) k").collect()}
    arrays = pa.array([[key[w] for w in words] for words in lists], pa.list_(pa.int64()))
    for piece in (toxicity.SLICE, 4):
        toxicity.SLICE, kept = piece, toxicity.SLICE
        got = model.measures(arrays)
        toxicity.SLICE = kept
        for words, (whole, lead) in zip(lists, got):
            n = len(words) + toxicity.SHRINK
            assert math.isclose(whole, sum(ratio(w, discounts)[0] if w in count else unseen for w in words) / n, rel_tol=1e-5, abs_tol=1e-6)
            want = sum(max(0.0, ratio(w, [toxicity.DISCOUNT] * 2)[0] - toxicity.LEAD) for w in words if w in count) / n
            assert math.isclose(lead ** 2, want, rel_tol=1e-5, abs_tol=1e-6)


def test_words_are_counted_as_they_are_looked_up(spark):
    odd = "Don't  stop\u00a0NOW\x85é_É ### \u4e2d\u6587, 1\u00b2 \x1cend"
    found = spark.createDataFrame([(odd,), (None,), (" ?! ",)], "t STRING").select(toxicity.words_of(F.col("t")).alias("w")).collect()
    assert [x.w for x in found] == [[w for w in map(toxicity.plain, odd.lower().split()) if w], [], []]


def test_a_worker_drops_what_another_operator_left():
    common.fresh_worker("one")
    common.worker_cache("memo", lambda: {1: 2})
    common.fresh_worker("one")
    assert common.worker_cache("memo", dict) == {1: 2}
    common.fresh_worker("other")
    assert common.worker_cache("memo", dict) == {}
    common.fresh_worker("done")


def test_shared_probabilities_sum_to_at_most_one(spark):
    grams = spark.createDataFrame([("\x02\x02a", 5), ("\x02ab", 3), ("\x02aa", 2), ("ab\x03", 3), ("aa\x03", 2)], "gram STRING, n_all BIGINT")
    sums = toxicity.shared_probabilities(grams).groupBy(F.substring("gram", 1, 2).alias("h")).agg(F.sum("shared").alias("s")).collect()
    assert all(0 < x.s <= 1 + 1e-9 for x in sums)


def test_language(documents, awkward, nothing):
    r = random.Random(10)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ei", "pf"], "cc": ["eau", "oi", "que", "è"]}
    texts, langs = [], []
    for i in range(600):
        g = r.choice(list(syllables))
        texts.append(" ".join("".join(r.choice(syllables[g]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(4, 60))))
        langs.append(g if i % 10 else None)
    texts += [None, "", "123 456 !"]
    langs += ["aa", None, "bb"]
    got = language.language_id(documents(texts, langs=langs)).collect()
    held = [x for x in got if x.held_out and langs[x.doc_id] and x.doc_id < 600]
    assert np.mean([x.lang_pred == langs[x.doc_id] for x in held]) >= 0.97 and all(0 <= x.score <= 1 for x in got)
    assert {x.lang_pred for x in got if x.doc_id >= 600} == {"und"}
    assert language.language_id(awkward).count() == 13 and language.language_id(nothing).count() == 0


def test_weights_are_sparse():
    learner = language.FollowTheLeader(50, 2)
    r = np.random.default_rng(1)
    for i in range(400):
        label = i % 2
        at = np.array([label, *r.choice(np.arange(2, 50), 5, replace=False)])
        learner.learn(at, np.array([1.0, *[0.002] * 5]), label)
    w = learner.weights(slice(None))
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0] and (w == 0).any()


# --- pipeline -----------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="session")
def staged(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out.append(docs)
    return out


def test_stages(spark, staged):
    start, clean, single, apart, mixed, coded = staged
    assert all(s.columns == start.columns for s in staged[1:5])
    score = {x.doc_id: x.predicted for x in toxicity.toxicity(start, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    assert {x.doc_id for x in clean.collect()} == {i for i, p in score.items() if not p}
    assert {x.doc_id for x in single.collect()} == {max(ids) for ids in brute_exact(clean.collect()).values()}
    assert {x.doc_id for x in apart.collect()} == {min(g) for g in brute_classes(single.collect())}
    copies = {x.doc_id: x.copies for x in mixing.mix(apart).collect()}
    assert collections.Counter(x.doc_id for x in mixed.collect()) == collections.Counter({i: n for i, n in copies.items() if n})
    texts = {x.doc_id: x.text for x in apart.collect()}
    for x in coded.collect():
        ids = LIBRARY.encode(texts[x.doc_id], add_special_tokens=False).ids
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(texts[x.doc_id]))


def test_run_equals_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, staged[-1].collect()))


def test_stages_on_awkward_and_empty(spark, awkward, nothing):
    for frame in (awkward, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL).cache()
        assert (docs.count() == 0) == (frame is nothing)
