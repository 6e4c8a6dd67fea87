"""SimHash, repeated bytes and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dimweave.llm import line_dedup, repeats, simhash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(names, prints):
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(names)):
        groups.setdefault(find(i), []).append(i)
    return {i: min((names[k] for k in own if names[k] is not None), default=None) for own in groups.values() for i in own}


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_near_fingerprints_share_a_key():
    golay, rng = simhash.Golay(), np.random.default_rng(2)
    prints = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300).astype(np.uint64)
    other = prints.copy()
    for i in range(len(other)):
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(b)
    keys = [[set() for _ in prints] for _ in range(2)]
    for own, values in zip(keys, (prints, other), strict=True):
        for at, key in zip(*simhash.bucket_keys(values, golay), strict=True):
            own[at].add(int(key))
    assert all(a & b for a, b in zip(*keys, strict=True))
    assert max(map(len, keys[0])) <= 56


def test_components_match_brute_force(documents):
    rng = random.Random(4)
    base = prose(rng, 400).split()
    rows = [(i, prose(rng, rng.randrange(0, 60))) for i in range(80)]
    for i in range(60):  # a large group of near copies and copies
        words = list(base)
        words[rng.randrange(len(words))] = f"w{i % 40}"
        rows.append((200 + i, " ".join(words)))
    rows += [(None, " ".join(base)), (900, None), (901, ""), (901, " \t\n"), (902, "A"), (903, "a"), (None, "only null here at all")]
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], prints)
    got = simhash.near_duplicates(documents(rows)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, f"{p:016x}", want[k]) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True))), key=key)
    kept = simhash.one_of_each(documents(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    named = {w for w in want.values() if w is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(named)
    assert simhash.near_duplicates(documents(rows).where("false")).count() == 0


def test_large_buckets_keep_their_components():
    prints = np.unique(np.bitwise_xor.accumulate(np.concatenate(([0], 1 << (np.arange(199) * 7 % 64))).astype(np.uint64)))
    a, b = simhash.bucket_links(np.zeros(len(prints), np.int64), prints)
    assert len(a) < len(prints)
    assert (np.bitwise_count(a ^ b) <= 3).all()


def test_equal_rows_leave_one(documents):
    kept = simhash.one_of_each(documents([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "x y z"), (None, "x y z")])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, "x y z"), (1, "a b c d")]


def plain_removal(texts):
    starts = {}
    for t in texts:
        for i in range(len(t) - 199):
            starts[t[i: i + 200]] = starts.get(t[i: i + 200], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if starts[t[i: i + 200]] > 1:
                gone[i: i + 200] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeating():
    rng = random.Random(9)
    shared = [prose(rng, 90) for _ in range(3)]
    texts = [prose(rng, rng.randrange(0, 200)) for _ in range(25)]
    for i in range(30):  # passages cut at any length around the limit, at starts and ends of texts too
        p = rng.choice(shared)
        a = rng.randrange(0, 60)
        p = p[a: a + rng.choice([150, 198, 199, 200, 201, 202, 215, 216, 230, 300, 400])]
        texts.append(prose(rng, rng.randrange(0, 40)) + p + prose(rng, rng.randrange(0, 40)))
    copy = texts[3] + texts[4]
    texts += [copy, copy, copy[:300] + "X" + copy[301:], "a" * 450, "ab" * 100, "é" * 150, shared[0] + "|" + shared[0], None, "", shared[1][:200], shared[1][:199]]
    return texts


def test_repeated_bytes_match_brute_force(documents, repeating):
    rows = [(None if i == 5 else i, t) for i, t in enumerate(repeating)]
    want = plain_removal([(t or "").encode() for t in repeating])
    got = repeats.remove_repeats(documents(rows, 3)).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    by_id = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert all(by_id[None if i == 5 else i] == w for i, w in enumerate(want))


def test_repeated_bytes_of_rows_with_one_doc_id(documents, repeating):
    rows = [(i % 7, t) for i, t in enumerate(repeating)] + [(1, repeating[40])] * 2
    got = repeats.remove_repeats(documents(rows, 3)).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(plain_removal([(t or "").encode() for _, t in rows]))
    assert repeats.remove_repeats(documents(rows).where("false")).count() == 0


def signed_hash(text):
    return (xxhash.xxh64_intdigest(text.encode(), seed=42) + 2**63) % 2**64 - 2**63


def plain_line_dedup(rows, limit, short_times=None):
    """Lists of removed lines of (doc_id, text) documents, by the rules that the operator states."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1])))
    lines, selected = [], []
    for d, (_, text) in enumerate(docs):
        own, begin = [], 0
        for at, line in enumerate(text.split("\n")):
            if line.strip(" "):
                own.append((at, line, len(line.strip(" ")), begin))
                begin += own[-1][2]
        lines.append(own)
        chosen = set()
        for i, (_, _, _, start) in enumerate(own):
            if begin - start >= limit:
                window = [j for j in range(i, len(own)) if own[j][3] < start + limit]
                chosen.add(min(window, key=lambda j: (signed_hash(own[j][1]), -j)))
        selected += [(d, i) for i in sorted(chosen)]

    def before(d, i):
        return [j for j in range(i - 1, -1, -1) if lines[d][j][3] >= lines[d][i][3] - limit]

    def after(d, i):
        end = lines[d][i][3] + lines[d][i][2]
        return [j for j in range(i + 1, len(lines[d])) if lines[d][j][3] + lines[d][j][2] <= end + limit]

    def keys(d, i):
        found = [(lines[d][i][1],)]
        if lines[d][i][2] < limit:
            found += [(lines[d][i][1], lines[d][j][1], side) for side, near in (("before", before(d, i)), ("after", after(d, i))) for j in near[:1]]
        return found

    firsts = {}
    for place in selected:
        for key in keys(*place):
            firsts.setdefault(key, place)
    gone = {d: set() for d in docs}
    for d, i in selected:
        for key in keys(d, i):
            e, k = firsts[key]
            if (e, k) == (d, i):
                continue
            reach, total = [i, i], lines[d][i][2]
            for side, near, theirs in ((0, before(d, i), before(e, k)), (1, after(d, i), after(e, k))):
                for a, b in zip(near, theirs, strict=False):
                    if lines[d][a][1] != lines[e][b][1]:
                        break
                    reach[side] = a
                    total += lines[d][a][2]
            if total >= limit:
                gone[docs[d]] |= set(range(lines[d][reach[0]][0], lines[d][reach[1]][0] + 1))
    if short_times:
        places = {}
        for d, own in enumerate(lines):
            for at, line, chars, _ in own:
                if chars < limit:
                    places.setdefault(line, []).append((d, at))
        for found in places.values():
            for d, at in found[1:] if len(found) >= short_times else []:
                gone[docs[d]].add(at)
    return gone


@pytest.mark.parametrize("times", [None, 3])
def test_line_dedup_matches_brute_force(documents, times):
    rng = random.Random(11)
    pool = [prose(rng, rng.choice([1, 1, 1, 2, 2, 3, 9, 12])) for _ in range(30)] + ["", " ", "}", "\t"]
    passages = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(2, 12))) for _ in range(8)]
    rows = [(i, "\n".join(rng.choice([rng.choice(pool), prose(rng, 8), prose(rng, 2), rng.choice(passages)]) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    rows += [(None, rows[4][1]), (70, None), (71, rows[5][1]), (72, "\n\n"), (71, rows[5][1]), (71, rows[6][1])]
    want = plain_line_dedup(rows, line_dedup.MIN_CHARS, times)
    given = documents(rows).withColumn("gone", F.lit(1)).withColumn("lines", F.lit("x")).withColumn("row", F.lit(2)).withColumn("at", F.lit(3))
    got = line_dedup.remove_later_runs(given, short_times=times).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["row"]["text"]
        gone = want[(r["row"]["doc_id"], text or "")]
        kept = "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in gone)
        assert (r["text"] or "") == kept
        assert r["n_removed"] == len(gone)
    assert sum(len(g) for g in want.values()) > 50
    lines_alone = {}
    for i, text in sorted({(i, t) for i, t in rows if i is not None and t}):
        for line in text.split("\n"):
            lines_alone.setdefault(line, []).append(i)
    if times is None:  # short lines that are repeated alone stay
        kept = "\n".join(r["text"] or "" for r in got).split("\n")
        assert any(len(x) < 10 and x.strip() and kept.count(x) > 1 for x in lines_alone)


def test_runs_of_short_lines_are_found_and_single_ones_stay(documents):
    run = "\n".join(f"verse {i} of it" for i in range(8))
    rows = [(1, f"alone\n{run}\nend"), (2, f"other\n{run}\nlast"), (3, "alone\nnot here\nverse 3 of it\nend"), (4, "verse 7 of it\nlast")]
    got = {r["row"]["doc_id"]: r["text"] for r in line_dedup.remove_later_runs(documents(rows)).collect()}
    assert got == {1: rows[0][1], 2: "other\nlast", 3: rows[2][1], 4: rows[3][1]}


def test_line_dedup_keeps_first_runs_and_takes_an_empty_table(documents):
    passage = "\n".join(f"line {i} of a passage that has quite a few words in it" for i in range(6))
    rows = [(1, f"alone\n{passage}\nend"), (2, f"other\n{passage}\nlast"), (3, "unlike the rest of them, a line by itself")]
    got = {r["row"]["doc_id"]: r["text"] for r in line_dedup.remove_later_runs(documents(rows)).collect()}
    assert got == {1: rows[0][1], 2: "other\nlast", 3: rows[2][1]}
    assert line_dedup.remove_later_runs(documents(rows).where("false"), short_times=3).count() == 0


def test_boilerplate_goes_wherever_it_stands(documents):
    rows = [(i, f"own {i} text\nAll rights reserved.\n" + ("twice only" if i < 2 else "tail")) for i in range(9)]
    got = {r["row"]["doc_id"]: r["text"] for r in line_dedup.remove_later_runs(documents(rows), short_times=3).collect()}
    assert got[0] == rows[0][1]
    assert got[1] == "own 1 text\ntwice only"
    assert got[2] == "own 2 text\ntail"
    assert all(got[i] == f"own {i} text" for i in range(3, 9))


def test_a_document_of_very_many_lines(documents):
    text = "\n".join(f"line {i % 30000} of this document, long enough for a window" for i in range(60000))
    got = line_dedup.remove_later_runs(documents([(1, text), (2, "short\n" * 20000)]), short_times=3).collect()
    assert {r["row"]["doc_id"]: r["n_removed"] for r in got} == {1: 30000, 2: 19999}
