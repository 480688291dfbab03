"""Spelling variants, tokenizer alignment and SimHash against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash

from tests.llm.plain import LOWER, words
from tidewater.llm import alignment, simhash, spelling
from tidewater.llm.fm_index import Vocabulary

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def key(row):
    return tuple((x is None, str(x)) for x in row)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# ------------------------------------------------------------ spelling
def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain_spelling(rows, occurrences=5, times=5):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= occurrences}
    near, by_length = {}, defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    for w in n:
        near[w] = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if one_edit(w, x)]
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=key)


def test_index_finds_every_word_one_edit_away():
    rng = random.Random(1)
    for trial in range(20):
        letters = "ab" if trial % 2 else "abcé÷"
        have = list({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(120)})
        ask = have + ["zzz", "abz", "zab", "a" * 40]
        index = Vocabulary(have)
        found = [{(ask[q], index.words[x]) for q, x in zip(*index.near(ask, side))} for side in ("left", "right")]
        assert found[0] | found[1] == {(a, b) for a in ask for b in have if one_edit(a, b)}
        # each side keeps its half
        assert all(b.startswith(a[:len(a) // 2]) for a, b in found[0])
        assert all(b.endswith(a[len(a) // 2:]) for a, b in found[1])


@pytest.fixture(scope="module")
def misspelt(spark):
    """Words in chains of counts, with accents, x-like signs, one hot word and
    a prefix that a third of the words share."""
    rng = random.Random(2)
    stems = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(6, 10))) for _ in range(60)]
    stems += ["common" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["été×÷À"]
    rows = []
    for i in range(300):
        text = []
        for _ in range(60):
            w = rng.choice(stems[:4]) if rng.random() < 0.5 else rng.choice(stems)
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "e" + w[at:], w[:at] + "ê" + w[at + 1:]])
            text.append(rng.choice([w, w.title()]))
        rows.append((i, rng.choice([" ", "-", "1"]).join(text)))
    rows += [(1000 + i, "chaining " * 2 + "chainingg " * (i < 40) + "chaininggg" * (i < 6)) for i in range(100)]
    rows += [(None, "Without " * 7), (5, None), (5, ""), (7, "q" * 50_000 + " " + "w" * 7), (7, "q" * 50_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("block", [40, 1 << 15])
def test_spelling(misspelt, block):
    rows, df = misspelt
    got = spelling.spelling_variants(df, block=block).collect()
    want = plain_spelling(rows)
    assert sorted(map(tuple, got), key=key) == want
    assert any(f and r != f for _, f, r, *_ in want)       # a chain of two forms


def test_spelling_of_odd_tables(spark, sample, odd, none):
    for df, least in ((sample, 5), (odd, 1)):
        got = spelling.spelling_variants(df, occurrences=least, times=2).collect()
        assert sorted(map(tuple, got), key=key) == plain_spelling(pairs_of(df), least, 2)
    assert spelling.spelling_variants(none).count() == 0


# ------------------------------------------------------------ alignment
def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def tokens(text):
        a = ta.encode(" " + text, add_special_tokens=False).ids
        b = tb.encode(text)
        xa = [bytes(char[c] for c in ta.id_to_token(i)) for i in a]
        xb = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode()
              for i in b]
        whole = (" " + text).encode()
        return (a, xa, b, xb) if b"".join(xa) == whole == b"".join(xb) else None

    def links(t):
        a, xa, b, xb = t
        out, i, j, ea, eb = [], 0, 0, len(xa[0]), len(xb[0])
        ga, gb, groups = [a[0]], [b[0]], []
        out.append((a[0], b[0]))
        while True:
            done_a, done_b = ea <= eb, eb <= ea
            if done_a and done_b:
                groups.append((ga, gb))
                ga, gb = [], []
            i, j = i + done_a, j + done_b
            if i == len(a) or j == len(b):
                break
            if done_a:
                ea += len(xa[i])
                ga.append(a[i])
            if done_b:
                eb += len(xb[j])
                gb.append(b[j])
            out.append((a[i], b[j]))
        return out, groups

    docs = []
    for d, t in rows:
        x = tokens(t) if t else None
        docs.append((d, x, *(links(x) if x else ([], []))))
    count = Counter(p for _, _, ls, _ in docs for p in set(ls))
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for d, x, ls, gs in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in gs)
        out.append((d, len(x[0]) if x else 0, len(x[2]) if x else 0, len(gs), len(ls), sum(count[p] == best[p[0]] for p in ls),
                    sum(count[p] for p in ls), hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out, key=key)


@pytest.mark.parametrize("frequent", [3, 500_000])
def test_alignment(spark, sample, odd, none, frequent):
    for df in (sample, odd):
        got = alignment.align_tokenizers(df, A, B, frequent).collect()
        assert sorted(map(tuple, got), key=key) == plain_alignment(pairs_of(df))
    assert alignment.align_tokenizers(none, A, B, frequent).count() == 0


def test_alignment_of_random_texts(spark):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", " ", "　", "▁", "a", "the", "don't", "'s", "é", "é", "漢字", "\U0001F600", "1234",
             "<s>", "<0x41>", "<|endoftext|>", "\0", "​", "ﬁ", "aaaa", "aa", "...", "ẞ", "_", " x", "\r\n", "͸"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = alignment.align_tokenizers(df, A, B, 50).collect()
    assert sorted(map(tuple, got), key=key) == plain_alignment(rows)


# ------------------------------------------------------------ simhash
def plain_fingerprint(text):
    w = words((text or "").translate(LOWER))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Smallest id reachable for (doc_id, fingerprint) rows."""
    distinct = sorted(set(f for _, f in prints))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, f in enumerate(distinct):
        for g in distinct[:i]:
            if (f ^ g).bit_count() <= 2:
                parent[find(f)] = find(g)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in prints]


def test_every_pair_within_two_bits_meets_in_a_table():
    masks = simhash.masks()
    assert len(masks) == 7 and {m.bit_count() for m in masks} <= {36, 37}
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


def test_simhash(spark, sample, odd, none):
    for df in (sample, odd):
        rows = [(d, plain_fingerprint(t)) for d, t in pairs_of(df)]
        got = simhash.simhash_components(df, bucket=2, hot=3).collect()
        assert sorted(map(tuple, got), key=key) == sorted(plain_components(rows), key=key)
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("bucket", [1, 4, 32])
def test_simhash_of_crowded_fingerprints(spark, bucket):
    """Fingerprints around a few centres, in chains of one and two bits and
    just beyond: small and large buckets give the same components."""
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = {0, 1 << 63, (1 << 64) - 1}
    for c in centres:
        for _ in range(150):
            f = c
            for _ in range(rng.choice([1, 2, 3, 3, 4, 5, 6, 7])):
                f ^= 1 << rng.randrange(64)
            prints.add(f)
    prints = [(i, f) for i, f in enumerate(rng.sample(sorted(prints), len(prints)))]
    fps = spark.createDataFrame([(simhash._signed(f),) for _, f in prints], "fp long")
    links = [(r.a, r.b) for r in simhash.near_fingerprints(fps, bucket).collect()]
    parent = {simhash._signed(f): simhash._signed(f) for _, f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
        parent[find(a)] = find(b)
    want = plain_components(prints)
    groups = defaultdict(set)
    for (i, f), (_, _, c) in zip(prints, want):
        groups[c].add(find(simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len({find(simhash._signed(f)) for _, f in prints})
