"""Source mix, token alignment and lexical search against DuckDB and plain versions of their contracts."""

import bisect
import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from dimweave.llm import alignment, lexical, mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def values(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("name", ["op11_source_mix", "op13_lexical_search"])
def test_queries_agree_with_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert values(got.select(*names).collect()) == values(want.fetchall())


def plain_targets(sizes):
    """By the contract's own words: share by weight, stop at the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest, open_ = sum(sizes.values()) - sum(fixed.values()), [s for s in names if s not in fixed]
        share = {s: Fraction(rest * weight[s], sum(weight[o] for o in open_)) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in above}


@pytest.fixture
def sources(spark):
    rng = random.Random(3)
    rows = []
    for source, n, most in ((None, 9, 30), ("", 5, 4), ("a", 60, 50), ("b", 3, 3), ("Z", 8, 9), ("é", 12, 12), ("c", 2, 0), ("\U0001f600", 7, 40), ("ﬀ", 6, 5)):
        rows += [(rng.randrange(10**6), " \t".join("x" * rng.randrange(1, 4) for _ in range(rng.randrange(most + 1))), "en", source, 0) for _ in range(n)]
    rows += [(7, "same row again", "en", "a", 0)] * 40 + [(None, "w\x0bw\x0cw\rw\xa0w", "en", "a", 0)] * 3 + [(8, None, "en", "b", 0), (None, None, None, None, None)]
    return rows


def test_targets_and_cuts(spark, sources):
    docs = spark.createDataFrame(sources, SCHEMA).withColumn("part", F.lit("clash")).withColumn("size", F.lit(-1)).repartition(5)
    got = mixing.mix(docs).collect()
    words = [len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in sources]
    sizes = {s: sum(n for n, r in zip(words, sources, strict=True) if r[3] == s) for s in {r[3] for r in sources}}
    want = plain_targets(sizes)
    assert any(want[s] == 3 * sizes[s] for s in sizes)
    assert len(got) == len(sources)
    assert values((r["doc_id"], r["source"], r["size"]) for r in got) == values((r[0], r[3], n) for n, r in zip(words, sources, strict=True))
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(want[s])) for r in own)
        assert sum(r["taken"] for r in own) == math.floor(want[s] + Fraction(1, 2))
        whole = math.floor(want[s] + Fraction(1, 2)) // sizes[s] if sizes[s] else 0
        assert all(whole * r["size"] <= r["taken"] <= min(3, whole + 1) * r["size"] for r in own)
        assert sum(whole * r["size"] < r["taken"] < (whole + 1) * r["size"] for r in own) <= 1
    again = mixing.mix(docs.repartition(3)).collect()
    fields = ("doc_id", "source", "size", "source_size", "target", "taken")
    assert values([r[f] for f in fields] for r in again) == values([r[f] for f in fields] for r in got)
    other = mixing.mix(docs, seed="other").collect()
    assert values([r[f] for f in fields] for r in other) != values([r[f] for f in fields] for r in got)


def test_mixed_texts_hold_the_words_taken(spark, sources, tmp_path):
    spark.createDataFrame(sources, SCHEMA).coalesce(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    found = Counter()
    for r in mixing.mixed_texts(docs).collect():
        assert (r["row"]["text"] or "").startswith(r["text"])
        found[r["row"]["doc_id"]] += len(re.findall("[^\x20\x09-\x0d]+", r["text"]))
    assert +found == +taken


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs).count() == 0
    empty = mixing.mix(spark.createDataFrame([(1, "", None, "a", 0), (2, None, None, None, 0)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in empty] == [(0, 0.0, 0)] * 2


ODD = [None, "", " ", "a", "  a  b ", "x▁y", "ends\n\n in  lines \n", "don't <s>stop</s> <|endoftext|> now", "\x00 \x01 tab\tbed", "naïve café über", "你好 \U0001f600 z é", "x" * 3000,
       "abcdefghij" * 300, "\xa0 nbsp　wide  space", "ﬁ ligature", "same words same words", "same words same words", "é ᠎ b", "word " * 2500]


def plain_alignment(texts):
    """By whole texts: both ids lists, groups by merging the ends, links by all pairs."""
    a = Tokenizer.from_file(queries.tokenizer_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    letters = {c: i for i, c in enumerate(bytes_to_letters())}
    entry = {i: bytes(letters[c] for c in e) for e, i in a.get_vocab().items() if all(c in letters for c in e)}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    rows = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled_a, spelled_b = [entry[i] for i in ids_a], [piece(i) for i in ids_b]
        if not text or not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
            rows.append([])
            continue
        groups, i, j, at_a, at_b, own_a, own_b = [], 0, 0, 0, 0, [], []
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b and i < len(ids_a):
                own_a.append(ids_a[i])
                at_a += len(spelled_a[i])
                i += 1
            else:
                own_b.append(ids_b[j])
                at_b += len(spelled_b[j])
                j += 1
            if at_a == at_b:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        rows.append(groups)
    return rows


def bytes_to_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


def plain_statistics(texts):
    aligned = plain_alignment(texts)
    counts, best = Counter(), {}
    for groups in aligned:
        counts.update({(a, b) for own_a, own_b in groups for a in own_a for b in own_b})
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for groups in aligned:
        linked = [(a, b) for own_a, own_b in groups for a in own_a for b in own_b]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(linked), sum(counts[p] == best[p[0]] for p in linked),
                     sum(counts[p] for p in linked), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return rows


def test_alignment_matches_whole_texts(spark, monkeypatch):
    rng = random.Random(6)
    texts = ODD + [" ".join("".join(rng.choice(["th", "ein", "é", "Qu", "12", ".", "-x", "\n", "zz", "ción"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(60))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("block", F.lit("x")).repartition(4)
    paths = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.statistics(docs, *paths).collect()}
    want = plain_statistics(texts)
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]
    shown = {r["doc_id"]: r["groups"] for r in alignment.aligned(docs, *paths).collect()}
    assert all((hashlib.sha256(g.encode()).hexdigest() if g else "") == want[i][-1] for i, g in shown.items())
    assert alignment.statistics(docs.where("false"), *paths).count() == 0


def test_alignment_over_small_blocks_and_a_small_memory():
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(30)) for _ in range(200)]
    paths = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
    small, large = alignment.Aligner(*paths, max_parts=60), alignment.Aligner(*paths)
    for at in range(0, 200, 20):
        a, b = (m.rows(texts[at: at + 20]) for m in (small, large))
        assert a[0] == b[0]
        assert all((x == y).all() for x, y in zip(a[1:], b[1:], strict=True))
    assert small.known < 300


def test_groups_are_the_shared_ends():
    assert [g.tolist() for g in alignment.groups(np.array([1, 3, 6]), np.array([3, 4, 6]))] == [[2, 3], [1, 3]]
    rng = random.Random(1)
    for _ in range(50):
        ends = [sorted({*rng.sample(range(1, 40), 10), 40}) for _ in range(2)]
        found = alignment.groups(*map(np.array, ends))
        shared = sorted(set(ends[0]) & set(ends[1]))
        assert [g.tolist() for g in found] == [[bisect.bisect(e, s) for s in shared] for e in ends]
    counted = lambda *ids: dict(zip(*(x.tolist() for x in alignment.links(*ids)), strict=True))
    assert counted([5, 6, 5], [9, 9]) == {5 << 32 | 9: 4, 6 << 32 | 9: 2}
    assert counted([5] * 30, list(range(40))) == {5 << 32 | b: 30 for b in range(40)}


def plain_search(docs, items, k):
    find = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                      for w in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    bags = [(i, Counter(find(t))) for i, t in docs if find(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    rows = []
    for item_id, text in dict.fromkeys(items):
        wanted, scored = set(find(text)), []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 20 * m)) for w in wanted if bag[w])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        rows += [(item_id, r, None if none else i, -score) for r, (score, none, i) in enumerate(sorted(scored)[:k], 1)]
    return rows


@pytest.fixture
def searched():
    rng = random.Random(9)
    word = lambda: rng.choice(["Alpha", "bETA", "γάμμα", "Γ", "e1", "don't", "x_y", "straße", "ÉT", "42", "the", "of"])
    docs = [(i, " ".join(word() for _ in range(rng.randrange(0, 12)))) for i in range(300)]
    docs += [(1000 - i, "alpha beta, the-of") for i in range(90)]  # a large class
    docs += [(None, "alpha beta the of"), (None, None), (5, ""), (5, " ,;"), (6, "Alpha " * 5000)] + [(77, "of the alpha")] * 4
    items = [(1, "alpha x y"), (2, "Straße ét 42"), (3, "nothing here"), (4, None), (5, ""), (None, "THE OF"), (6, "beta beta γάμμα"), (6, "beta beta γάμμα"), (7, "alpha x y"), (8, " ".join(word() for _ in range(40)))]
    return docs, items


@pytest.mark.parametrize(("k", "chars"), [(50, 10**6), (3, 10**6), (7, 20)])
def test_search_matches_plain_scores(spark, searched, monkeypatch, k, chars):
    docs, items = searched
    monkeypatch.setattr(lexical, "BLOCK_CHARS", chars)
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumn("block", F.lit(1)).withColumn("score", F.lit(1)).repartition(6)
    got = lexical.search(given, spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit(3)), k).collect()
    assert values(got) == values(plain_search(docs, items, k))


def test_search_of_nothing(spark, searched):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(searched, ("doc_id long, text string", "item_id long, text string"), strict=True))
    assert lexical.search(docs.where("false"), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0
