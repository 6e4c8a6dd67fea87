"""Token encoder, token store and packing against plain encoding and exhaustive search."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimweave.llm import packing, token_store
from dimweave.llm.common import new_folder, open_store
from dimweave.llm.tokens import PartEncoder

ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "\n\n x  y \n", "it's  don't 's", "é è  ü", "<|endoftext|> x", "a <|endoftext|> b<|endoftext|><|endoftext|>c \n<|endoftext|>", "<|endoftext|", "x'll we're 'tis don'ts\nOf  it.\t\tA1b2", "a　 b 12 3,4  ", "\x1c a \x1c b", "x᠎ y",
       "你好 \U0001f600 z", "the " * 3000, "x" * 20000]


@pytest.fixture(scope="module")
def plain(tokenizer_file):
    tokenizer = Tokenizer.from_file(tokenizer_file)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_parts_give_the_ids_of_whole_texts(tokenizer_file, plain):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab .'\n\t é1!") for _ in range(60)) for _ in range(300)]
    encoder = PartEncoder(tokenizer_file, max_parts=50)  # forgets again and again
    for at in range(0, len(texts), 40):
        some = texts[at: at + 40]
        flat, lengths, _, _ = encoder.encode(some)
        ends = np.cumsum(lengths)
        for text, a, b in zip(some, ends - lengths, ends, strict=True):
            assert flat[a:b].tolist() == plain(text), text[:50]


def test_added_tokens_can_be_plain_text(tokenizer_file):
    plain = Tokenizer.from_file(tokenizer_file)
    plain.encode_special_tokens = True
    flat, lengths, _, _ = PartEncoder(tokenizer_file, added_tokens=False).encode(ODD)
    assert np.split(flat, np.cumsum(lengths)[:-1])[10].tolist() == plain.encode(ODD[10], add_special_tokens=False).ids
    assert flat.tolist() == [i for t in ODD for i in plain.encode(t, add_special_tokens=False).ids]


def test_the_memory_keeps_what_is_used_often(tokenizer_file):
    encoder = PartEncoder(tokenizer_file, max_parts=100)
    for k in range(30):
        encoder.encode([" ".join(["the", "of", *(f"rare{k}x{i}" for i in range(20))])])
    assert encoder.known <= 140
    assert {"of", b"the"} <= set(encoder.numbers)


def test_perfect_hash_has_a_slot_for_each_key_and_no_other():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(2**62), 2**62, 5000))
    hashed = token_store.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    assert len(token_store.PerfectHash.build(keys[:0]).slots(keys[:3])) == 3
    with pytest.raises(ValueError, match="distinct"):
        token_store.PerfectHash.build(np.array([1, 1]))


def stored(docs, tokenizer_file):
    folder = new_folder(docs.sparkSession, "tokens")
    token_store.write_store(docs, folder, tokenizer_file)
    return folder


def test_store_round_trip_with_nulls_and_repeated_keys(spark, documents, tokenizer_file, plain):
    rows = [(7, "one two"), (3, None), (3, "same id"), (3, "same id"), (None, "no key"), (None, None), (-5, ODD[8]), *((100 + i, t) for i, t in enumerate(ODD))]
    docs = documents(rows)
    folder = stored(docs, tokenizer_file)
    buckets = token_store.bucket_count(len(rows))
    got = token_store.read_store(docs, folder, buckets).unionByName(token_store.read_unkeyed(spark, folder)).collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(plain(text) + [0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)


def test_documents_of_one_doc_id_or_none_span_shards(spark, documents, tokenizer_file, plain):
    rows = [(5 if i % 2 else None, f"{i * 7919 % 10007} words") for i in range(20_000)] + [(4, "before"), (6, "after"), (5, "0 words"), (5, "0 words")]
    docs = documents(rows)
    folder = stored(docs, tokenizer_file)
    found = token_store.read_store(docs, folder, token_store.bucket_count(len(rows)))
    got = found.unionByName(token_store.read_unkeyed(spark, folder)).toPandas()
    assert len(got) == len(rows)
    assert got.groupby("doc_id", dropna=False)["shard"].nunique().max() > 1
    assert (spark.read.parquet(f"{folder}/slices").toPandas()["copies"] <= token_store.SLICE).all()
    got = got.sort_values("start").reset_index()
    assert (got["n_tokens"].cumsum() - got["n_tokens"] == got["start"]).all()
    want = sorted(((i is not None, i or 0, t) for i, t in rows))
    assert got["doc_id"].fillna(0).astype(int).tolist() == [i for _, i, _ in want]
    assert got["ids_crc32"].tolist() == [zlib.crc32(np.array(plain(t) + [0], "<u4").tobytes()) for *_, t in want]


def test_a_repeated_task_finds_its_file(tmp_path):
    class Strict:
        """A file system that does not rename onto a file."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            if (tmp_path / "x").exists():
                raise OSError("exists")
            self.fs.move(a, b)

    fs, path = open_store(str(tmp_path / "x"))
    for attempt in range(2):
        (tmp_path / f"own{attempt}").write_text("same")
        token_store.publish(Strict(fs), str(tmp_path / f"own{attempt}"), path)
        assert [f.name for f in tmp_path.iterdir()] == ["x"]
    with pytest.raises(OSError):
        token_store.publish(fs, str(tmp_path / "none"), str(tmp_path / "y"))


def test_store_tells_foreign_keys_apart_and_takes_an_empty_table(spark, documents, tokenizer_file):
    folder = stored(documents([(i, f"text {i}") for i in range(500)]), tokenizer_file)
    asked = spark.range(490, 2000).withColumnRenamed("id", "doc_id")
    assert sorted(r["doc_id"] for r in token_store.read_store(asked, folder, 1).collect()) == list(range(490, 500))
    fs, inner = open_store(folder)
    assert not [f.path for f in fs.get_file_info(__import__("pyarrow.fs").fs.FileSelector(inner, recursive=True)) if "attempt" in f.path]
    none = documents([(1, "x")]).where("false")
    empty = stored(none, tokenizer_file)
    assert token_store.read_store(none, empty, 1).count() == 0
    assert token_store.read_unkeyed(spark, empty).count() == 0


def cheapest(states, costs, window):
    best = [0.0] + [float("inf")] * (len(states) - 1)
    for j in range(1, len(states)):
        for i in range(j):
            n = states[j] - states[i]
            if n <= window:
                power = n < window and n & (n - 1) == 0
                best[j] = min(best[j], best[i] + min(window - n, packing.SHORT_COST if power else window) + costs[j])
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(5)
    for _ in range(60):
        states = np.unique([0, *(rng.randrange(1, 400) for _ in range(rng.randrange(20, 80))), *range(0, 400, 60)])
        costs = np.array([rng.choice([0.0, 4.0, 16.0]) for _ in states])
        cuts = packing.plan_cuts(states, costs, 64)
        price = dict(zip(states.tolist(), costs.tolist(), strict=True))
        total = 0.0
        for a, b in zip([0, *cuts], cuts, strict=False):
            n = b - a
            total += min(64 - n, packing.SHORT_COST if n < 64 and n & (n - 1) == 0 else 64) + price[b]
        assert cuts[-1] == states[-1]
        assert total == pytest.approx(cheapest(states.tolist(), costs.tolist(), 64))


def test_packing_holds_every_id_once_with_little_padding(spark, documents, tokenizer_file, plain):
    rows = [(i, " ".join(f"w{i * j}." for j in range(i % 97 * 5))) for i in range(150)] + [(None, None), (4, ""), (4, ""), (900, "x " * 9000), *((1000 + i, t) for i, t in enumerate(ODD))]
    pieces = packing.pack(documents(rows), tokenizer_file).toPandas()
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(doc_id, []).append(plain(text) + [1])
    for row in pieces.itertuples():
        key = None if row.doc_id != row.doc_id else int(row.doc_id)
        own = [np.array(x, "<u4")[row.start: row.start + row.length] for x in ids[key] if len(x) == row.doc_tokens]
        assert row.ids_crc32 in {zlib.crc32(x.tobytes()) for x in own if len(x) == row.length}
    assert pieces["length"].sum() == sum(len(x) for own in ids.values() for x in own)
    padding = 0
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert (own["length"].cumsum() - own["length"] == own["offset"]).all()
        n = own["length"].sum()
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding < 0.01 * pieces["length"].sum()
    assert packing.pack(documents([(1, "x")]).where("false"), tokenizer_file).count() == 0


def test_equal_parts_of_texts_are_looked_up_once(tokenizer_file):
    encoder, asked = PartEncoder(tokenizer_file), []
    number = encoder.number
    encoder.number = lambda parts, *times: asked.extend(parts) or number(parts, *times)
    text = " ".join(["one", *["the", "of"] * 50])
    flat, lengths, _, _ = encoder.encode([text, text])
    assert sorted(map(str, asked)) == ["b'one'", "b'one'", "of", "the"]
    assert encoder.uses[: encoder.known].tolist() == [100, 100, 2]
    ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert flat.tolist() == ids * 2 and lengths.tolist() == [len(ids)] * 2


@pytest.mark.parametrize("texts", [[""], ["", "a  b"], ["a  b", "\n c"], [" ", "a", "", " a "], ["a<|endoftext|>b c", "b c"]])
def test_texts_that_are_cut_in_either_way(tokenizer_file, texts):
    encoder = PartEncoder(tokenizer_file)
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    flat, lengths, starts, ends = encoder.encode(texts)
    assert flat.tolist() == [i for ids in want for i in ids]
    assert lengths.tolist() == list(map(len, want))
    assert len(starts) == len(ends) and (np.diff(starts) >= 0).all()
