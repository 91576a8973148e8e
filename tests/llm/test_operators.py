"""The corpus operators against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.functions.bits import with_hit
from martflow.llm import (
    blocks,
    graph,
    imatch,
    licenses,
    lines,
    packing,
    phrases,
    pii,
    quality,
    queries,
    repeats,
    simhash,
    token_files,
    tokens,
)
from martflow.sources.workdir import shared_folder

SCHEMA = "doc_id bigint, text string, key string, mark bigint, words string"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(200)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """NULL keys and texts, empty and long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 977} é{i}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven\n\nMail a@b.co now", "k", 1, "w"),
        (1, "one two three four five six seven\n\nMail a@b.co now", "k", 1, "w"),
        (1, "another text of the same key", None, None, None),
        (2, None, "k", 2, "w"),
        (3, "", "k", 3, "w"),
        (4, " \t\n", "k", 4, "w"),
        (None, "text without a key", "k", 5, "w"),
        (None, None, None, None, None),
        (5, long, "k", 6, "w"),
        (6, long, "k", 7, "w"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _fingerprint(text, width=3):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, ids, distance=2):
    prints, own = np.array(prints, np.uint64), np.array(ids)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance
    while True:
        new = np.where(near, own[None, :], (1 << 63) - 1).min(axis=1)
        if (new == own).all():
            return own.tolist()
        own = new


def test_near_duplicates_equal_brute_force(docs, texts):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [_fingerprint(t) for _, t in texts]
    roots = _groups(prints, [i for i, _ in texts])
    for (i, _), p, root in zip(texts, prints, roots, strict=True):
        assert (found[i]["fingerprint"], found[i]["component_id"]) == (f"{p:016x}", root)


@pytest.mark.parametrize("node_rows", [200_000, 8])
def test_trie_join_finds_every_group(spark, node_rows):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(20):
            prints.add(int(s) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), False)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "print bigint")
    roots = graph.components(simhash.near_links(nodes, node_rows=node_rows), "a", "b")
    found = {r["node"]: r["root"] for r in roots.collect()}
    wanted = _groups(prints, signed)
    linked = {p: r for p, r in zip(signed, wanted, strict=True) if wanted.count(r) > 1}
    assert found == linked


def test_near_duplicates_of_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd)
    zero = [r["component_id"] for r in found.collect() if r["fingerprint"] == "0" * 16]
    assert zero == [2] * 4 and found.count() == 10
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # of the five groups one row each; a NULL key only where a group has no other
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "2", "5", "None"]
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in graph.components(chain, "a", "b").collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_quality_on_held_out_rows(spark, odd, empty):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = queries.op2(spark, sf_dir).join(labels, "doc_id").filter("held_out")
    right, rows = scores.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert rows > 100 and right / rows > 0.97
    few = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 0, 1), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.quality_scores(odd, few).collect()
    assert len(found) == 10 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["score"] == 0.5 for r in quality.quality_scores(odd, few.limit(0)).collect())
    assert quality.quality_scores(empty, few).count() == 0
    assert [r["held_out"] for r in found if r["doc_id"] == 5] == [zlib.crc32(b"5") % 3 == 1]


def test_quality_scores_hold_little_at_a_time():
    word = [f"w{i * 7919 % 9973}" for i in range(1500)]
    texts = pa.array([" ".join(word[k * 13 % 1000 :][:500]) for k in range(2000)])
    weight = np.random.default_rng(1).normal(0, 1, 1 << quality.BUCKET_BITS).astype(np.float32)
    blocks.powers.cache_clear()
    tracemalloc.start()
    found = quality.scores(texts, weight, 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 6 MB of texts; blocks of 2 MB took 178 MB
    assert peak < 48e6
    alone = [quality.scores(texts[k : k + 1], weight, 0.1)[0] for k in (0, 700, 1999)]
    assert np.allclose(found[[0, 700, 1999]], alone, rtol=0, atol=1e-9)


def test_quality_examples_have_one_order():
    rng = np.random.default_rng(2)
    examples = [
        (rng.integers(0, 3, n).astype("<i4"), rng.integers(0, 2, n).astype(np.float32), int(y))
        for n, y in zip(rng.integers(0, 4, 200), rng.integers(0, 2, 200), strict=True)
    ]

    def marks(x):
        return x[2], len(x[0]), x[0].tobytes(), x[1].tobytes()

    assert [marks(x) for x in quality._ordered(examples)] == sorted(map(marks, examples))


def test_quality_features_stay_within_their_text():
    together = ["ab cd ab", "", "x", "cd cd é", "  "]
    data = pa.array(together)
    (_, offsets, raw), = blocks.blocks(data)
    joined = quality.features(raw, offsets)
    for i, text in enumerate(together):
        for (bucket, at), (own, _) in zip(
            joined, quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])), strict=True
        ):
            assert bucket[at[i] : at[i + 1]].tolist() == own.tolist()


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def _contamination(rows, items, size=10):
    windows = {}
    for item, text in items:
        own = _words(text)
        for i in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    for key, text in rows:
        own, hit, named = _words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if found := windows.get(tuple(own[i : i + n])):
                    hit |= set(range(i, i + n))
                    named |= found
        yield key, (len(own), len(hit), sorted(named))


def test_contamination_equals_brute_force(spark, docs, texts, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    more = [(900, texts[3][1][:200]), (901, "of"), (902, ""), (903, None), (904, texts[3][1][:200])]
    items = items.unionByName(spark.createDataFrame(more, "item_id bigint, text string"))
    plain = [tuple(r) for r in items.collect()]
    wanted = dict(_contamination(texts, plain))
    for r in phrases.contamination(docs, items).collect():
        assert (r["n_words"], r["n_hit"], r["items"]) == wanted[r["doc_id"]]
    # the same in many small blocks of items
    index = phrases.build_index(docs)
    one = phrases.matches(index, items).orderBy("shard", "row", "item_id").collect()
    assert one == phrases.matches(index, items, item_bytes=500).orderBy("shard", "row", "item_id").collect()


def test_phrases_near_and_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "seven six one"), (None, "one two three"), (2, "é")], "item_id int, text string")
    index = phrases.build_index(odd)
    near = phrases.matches(index, items, slop=7).filter("item_id = 1")
    assert near.count() == 2
    assert phrases.matches(index, items).filter("item_id = 1").count() == 0
    found = phrases.contamination(odd, items)
    assert found.count() == 10 and found.filter("contaminated").count() == 2
    assert phrases.contamination(empty, items).count() == 0
    assert phrases.contamination(odd, items.limit(0)).filter("contaminated").count() == 0
    values = np.array([0, 1, 127, 128, 16383, 16384, 1 << 40])
    assert phrases.unpack(phrases.pack(values)).tolist() == values.tolist()


def _repeats(rows, size=100):
    seen, out = set(), {}
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if raw[i : i + size] in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(raw[i : i + size])
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        many = len(re.findall(b"\1+", bytes(gone)))
        out[key] = (len(raw), sum(gone), many, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, texts):
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abc é"), 700))
    rows = [(i, t) for i, t in texts if len(t) < 6000][:60]
    rows += [(1000 + i, base[int(a) : int(a) + int(n)]) for i, (a, n) in enumerate(rng.integers(0, 500, (40, 2)))]
    rows += [(2000, "xy" * 400), (2001, "z" * 99), (2002, "z" * 100), (2003, "z" * 301), (2004, ""), (2005, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = repeats.without_repeats(df, with_bytes=True).collect()
    wanted = _repeats(rows)
    for r in found:
        removed = sum(x["end"] - x["start"] for x in r["spans"])
        assert (r["n_bytes"], removed, len(r["spans"]), r["kept_sha256"]) == wanted[r["doc_id"]]
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_repeats_of_a_passage_in_many_surroundings(spark):
    """No anchor of a large group of near copies is left to be sorted by one task."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefgh "))
    base = "".join(rng.choice(letters, 260))
    rows = []
    for i in range(3000):
        changed = "".join(rng.choice(letters, 60))
        rows.append((i, changed + base[:130] + (f"{i:04d}" if i % 3 else "") + base[130:] + changed[::-1]))
    # a long text that holds the passage many times
    rows.append((5000, "".join(f"{i:05d}" + base[20:150] + f"{7 * i:06d}" for i in range(2000))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    wanted = _repeats(rows)
    for r in repeats.without_repeats(df).collect():
        removed = sum(x["end"] - x["start"] for x in r["spans"])
        assert (r["n_bytes"], removed, len(r["spans"]), r["kept_sha256"]) == wanted[r["doc_id"]]
    found = repeats._classes(df.withColumnRenamed("doc_id", "doc"), repeats.LENGTH, repeats.ANCHOR, 8)
    most = found.filter("open").groupBy("anchor").count().agg(F.max("count")).first()[0]
    assert (most or 0) < 1500


def test_contexts_are_sorted_by_whole_anchors():
    anchors = np.repeat(np.arange(5, dtype=np.uint64), [3, repeats.SORTED + 5, 2, repeats.SORTED - 2, 1])
    found = [(x.start, x.stop) for x in repeats._whole_anchors(anchors)]
    n = repeats.SORTED
    assert found == [(0, 3), (3, n + 8), (n + 8, 2 * n + 8), (2 * n + 8, 2 * n + 9)]


def test_repeats_of_odd_rows(odd, empty):
    found = repeats.without_repeats(odd).collect()
    size = {r["doc_id"]: r["n_bytes"] for r in found}
    gone = {r["doc_id"]: sum(x["end"] - x["start"] for x in r["spans"]) for r in found}
    assert len(found) == 10 and gone[6] == size[6] > 600_000 and gone[1] == 0
    assert repeats.without_repeats(empty).count() == 0


def test_personal_data(spark, odd, empty):
    rows = [
        (1, "Mail: a.b@c-d.co.uk,x@y z@w.co\nip 1.2.3.4 256.1.1.1 1.2.3.4.5 0001.02.3.255"),
        (2, "card 4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (988) 555-2485; +49 30 12"),
        (3, "account DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432, DE89370400440532013001"),
        (4, "social security 078-05-1120, but 078-05-1120x"),
        (5, "1" * 20000 + " " + "1.2." * 5000 + "a" * 20000 + "@" + "b" * 3000 + " é a@b.co_x@y.zz"),
    ]
    found = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [found[1][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [2, 3, 0, 0]
    assert [found[2][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [0, 0, 1, 1]
    assert [x["kind"] for x in found[3]["spans"]] == ["iban", "iban"]
    assert [x["kind"] for x in found[4]["spans"]] == ["ssn", "ssn"][:1]
    assert found[5]["n_email"] == 2
    assert found[1]["spans"][0]["score"] > 0.9  # the word before it adds to the score
    odd_rows = pii.personal_data(odd).collect()
    assert len(odd_rows) == 10 and sum(r["n_email"] for r in odd_rows) == 2
    assert pii.personal_data(empty).count() == 0


def _base_spans(text):
    """The base kinds by plain regular expressions, in the order in which they are listed."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    }

    def valid(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(part) <= 255 for part in match.split("."))
        if kind == "card":
            twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern) in enumerate(patterns.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return sorted(found)


def test_personal_data_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in queries.op5(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        base = _base_spans(text)
        digest = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in base)
        assert found[doc_id]["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        for i, kind in enumerate(("email", "ip", "card", "phone")):
            assert found[doc_id][f"n_{kind}"] == sum(x[1] == i for x in base)
        listed = found[doc_id]["spans"].split(",") if found[doc_id]["spans"] else []
        assert set(digest.split(",")) - {""} <= set(listed)
        for span in set(listed) - set(digest.split(",")):
            kind, start, end = span.split(":")
            assert kind in ("iban", "ssn", "secret") and text[int(start) : int(end)].strip()


def test_personal_data_of_a_text_of_matches(spark):
    """Places stay right in a text of many matches, and the work does not grow with their square."""
    n = 50_000
    text = " ".join(f"é user{i}@example.org 10.0.{i % 300}.1" for i in range(n))
    found = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id int, text string")).head()
    assert [(x["start"], x["order"], x["end"], x["kind"]) for x in found["base"]] == _base_spans(text)
    assert found["n_email"] == n


def test_personal_data_added_kinds(spark):
    hex_ = "11acdfb36bb72224148e6160f674b4be45601bff"
    cases = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF": ["iban:5:32"],
        "IBAN DE89370400440532013000 GB82WEST12345698765432": ["iban:5:27", "iban:28:50"],
        "IBAN DE89370400440532013001": [],  # checksum
        "IBAN DE8937040044053201300": [],  # length
        f'token = "{hex_}"': ["secret:9:49"],
        f"commit {hex_}": [],  # no context
        "secret " + "a" * 40 + " key " + "1" * 40: [],
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(rows).collect()}
    for i, (text, spans) in enumerate(cases.items()):
        added = [f"{x['kind']}:{x['start']}:{x['end']}" for x in found[i] if x["order"] > 3]
        assert added == spans, text


def test_imatch(spark, docs, texts, odd, empty):
    found = {r["doc_id"]: r for r in imatch.edited_fingerprints(docs).collect()}
    alike = 0
    for n, (i, t) in enumerate(texts):
        after = texts[(n + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        assert found[i]["n_chars"] == len(t)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i]["near_next"] <= 1
        alike += found[i]["near_edited"] > found[i]["near_next"]
    assert alike > 0.9 * len(texts)
    by_text = {}
    for i, t in texts:
        by_text.setdefault(t, set()).add(found[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    assert imatch.edited_fingerprints(odd).count() == 10
    assert imatch.edited_fingerprints(empty).count() == 0


def test_imatch_of_a_group_of_near_copies(spark):
    """A group that is a third of all rows has no term in the band, nor has a text of rare words."""
    rng = np.random.default_rng(4)
    base = [f"shared{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for j in rng.integers(0, len(base), 3):
            words[int(j)] = f"edit{i}x{j}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, " ".join(f"other{x}" for x in rng.integers(0, 3000, 100))) for i in range(300)]
    rows += [(600 + i, " ".join(f"rare{i}y{j}" for j in range(100))) for i in range(300)]
    found = {r["doc_id"]: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(found) == 900
    copies = [found[i]["near_next"] for i in range(299)]
    assert sum(x > 0 for x in copies) > 0.99 * 299 and np.mean(copies) > 0.5
    for low in (300, 600):
        assert np.mean([found[i]["near_edited"] for i in range(low, low + 299)]) > 0.25
        assert np.mean([found[i]["near_next"] for i in range(low, low + 299)]) < 0.05


def test_imatch_counts_a_text_once(spark):
    rows = [(i, "alpha beta gamma") for i in range(50)] + [(50 + i, f"alpha w{i % 25} v{i}") for i in range(50)]
    found = imatch.lexicon(spark.createDataFrame(rows, "doc_id bigint, text string"), "text", 0.001, 0.5)
    words = {r[0] for r in spark.sql("SELECT explode(transform(sequence(0, 24), x -> xxhash64('w' || x)))").collect()}
    assert {r["term"] for r in found.collect()} == words


def test_encoder_equals_library(texts):
    path = tokens.default_tokenizer()
    library = Tokenizer.from_file(path)
    some = [t for _, t in texts[:40]] + ["", " ", "İ ﬁ Åͅ é́ 😀", "<|endoftext|>a 's'S ²x_y\x1cz\x85", "日本 語"]
    coder = tokens.Encoder(path)
    found = [ids[a:b].tolist() for _, ids, at in tokens.encoded(pa.array(some), coder) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert found == [library.encode(t, add_special_tokens=False).ids + [2] for t in some]


def test_encoder_forgets_without_harm(texts, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    coder, whole = tokens.Encoder(tokens.default_tokenizer()), tokens.encoder(tokens.default_tokenizer())
    for _, t in texts[:30]:
        raw = t.encode()
        at = np.array([0, len(raw)])
        assert coder.block(raw, at)[0].tolist() == whole.block(raw, at)[0].tolist()


def test_token_files_round_trip(spark, docs, texts, odd, empty, tmp_path):
    library = Tokenizer.from_file(tokens.default_tokenizer())
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in texts}
    before = 0
    for r in sorted(token_files.token_files(docs).collect(), key=lambda r: r["doc_id"]):
        own = ids[r["doc_id"]]
        crc = zlib.crc32(np.array(own, "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (before, len(own), crc)
        before += len(own)
    path = str(tmp_path / "shards")
    token_files.write_shards(docs, path, shard_ids=10_000)
    shards = token_files.read_shards(docs, path)
    keys = spark.createDataFrame([(texts[5][0],), (texts[-1][0],), (-7,), (1 << 50,), (None,)], "k bigint")
    found = {r["k"]: r["ids"] for r in token_files.lookup(shards, keys, "k").collect()}
    assert found == {i: ids[i] for i in (texts[5][0], texts[-1][0])}
    assert token_files.token_files(odd).agg(F.sum("n_tokens"), F.count("*")).first()[1] == 10
    assert token_files.token_files(empty).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    keys = np.unique(keys)
    index = token_files.PerfectHash.build(keys)
    index = token_files.PerfectHash(index.levels, index.bits, index.ranks.astype(np.int64))
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


def test_plan_packs_whole_histograms():
    rng = np.random.default_rng(0)
    for _ in range(60):
        size = int(rng.choice([8, 64, 4096]))
        histogram = {int(k): int(rng.choice([1, 3, 50])) for k in rng.integers(1, size + 1, rng.integers(0, 60))}
        found = packing.plan(histogram, size)
        lengths = np.repeat(sorted(histogram), [histogram[k] for k in sorted(histogram)]).astype(int)
        rank = np.arange(len(lengths))
        i = np.searchsorted(found.first, rank, "right") - 1
        sequence = found.sequence[i] + (rank - found.first[i]) // found.each[i]
        offset = found.offset[i] + (rank - found.first[i]) % found.each[i] * found.length[i]
        order = np.lexsort((offset, sequence))
        ends = {}
        for s, o, n in zip(sequence[order], offset[order], lengths[order], strict=True):
            assert ends.get(s, 0) == o
            ends[s] = o + n
        assert all(e <= size for e in ends.values()) and len(ends) == found.sequences


def test_packed_sequences(docs, odd, empty):
    found = packing.packed(docs).collect()
    assert len({(r["doc_id"], r["start"]) for r in found}) == len(found)
    used = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert used.get(r["sequence_id"], 0) == r["offset"]
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= packing.SEQUENCE and sum(used.values()) > 0.9 * packing.SEQUENCE * len(used)
    whole = packing.sequences(docs).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in whole} == used
    assert packing.packed(odd).filter("start = 0").count() == 10
    assert packing.packed(empty).count() == 0


def test_packed_pieces_hold_every_id_once(spark, sf_dir):
    library = Tokenizer.from_file(tokens.default_tokenizer())
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    ends = dict.fromkeys(ids, 0)
    for r in sorted(queries.op9(spark, sf_dir).collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == ends[r["doc_id"]] and r["doc_tokens"] == len(own)
        piece = own[r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        ends[r["doc_id"]] += r["length"]
    assert ends == {i: len(own) for i, own in ids.items()}


def test_license_scan(spark, odd, empty):
    mit = licenses.TEMPLATES["mit"]
    rows = [
        (1, "abc def. Released under the MIT License.\nfoo Released under the MIT License. bar"),
        (2, "x " * 50 + mit.replace("without restriction", "") + " y" * 50),
        (3, "the work of the license and the version of this"),
        (4, "Licensed under the Apache License, Version 2.0."),
        (5, "this stray word, then five more. This work is licensed under the GNU General Public License, version 3."),
    ]
    found = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert (found[1]["license"], found[1]["n_matches"], found[1]["coverage"]) == ("mit-notice", 2, 1.0)
    assert found[2]["license"] == "mit" and found[2]["coverage"] > 0.9
    assert found[3]["license"] is None and found[4]["license"] == "apache-2.0-notice"
    assert (found[5]["license"], found[5]["matches"]) == ("gpl-3.0-notice", "gpl-3.0-notice:6:18")
    a, b = "a b c d e f g".split(), "x b c y e a g".split()
    assert [p for p in licenses.align(a, b)] == [(1, 1), (2, 2), (4, 4), (6, 6)]
    assert licenses.license_scan(odd).count() == 10 and licenses.license_scan(empty).count() == 0


def test_other_versions_and_kinds_are_not_taken_for_a_license(spark):
    gpl = licenses.TEMPLATES["gpl-3.0"]
    texts = [
        gpl.replace("version 3", "version 2"),
        gpl.replace("GNU General", "GNU Lesser General"),
        gpl.replace("GNU General", "GNU Affero General"),
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under CC BY-ND 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        licenses.TEMPLATES["apache-2.0"].replace("Version 2.0", "Version 1.1"),
    ]
    df = spark.createDataFrame([*enumerate(texts), *enumerate(licenses.TEMPLATES.values(), 100)], "doc_id int, text string")
    found = {r["doc_id"]: r for r in licenses.license_scan(df).collect()}
    assert [found[i]["license"] for i in range(len(texts))] == [None] * len(texts)
    assert [found[i]["license"] for i in range(100, 100 + len(licenses.TEMPLATES))] == list(licenses.TEMPLATES)


def _late(rows, similarity=0.8):
    seen, gone = [], {}
    for key, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            own = frozenset(w for w in line.lower().split(" ") if w)
            if own and any(len(own & s) >= similarity * len(own | s) - 1e-9 for s in seen):
                gone.setdefault(key, []).append(n)
            if own:
                seen.append(own)
    return gone


@pytest.mark.parametrize("hot_rank", [lines.HOT_RANK, 3])
def test_line_dedup_equals_brute_force(spark, texts, odd, empty, hot_rank, monkeypatch):
    monkeypatch.setattr(lines, "HOT_RANK", hot_rank)  # with three, words found four times take the way of hot words
    words = [f"w{i}" for i in range(40)]
    rng = np.random.default_rng(2)
    rows = list(texts[:25])
    for i in range(60):
        some = list(words[: 8 + i % 20])
        some[int(rng.integers(len(some)))] = f"v{int(rng.integers(6))}"
        rows.append((5000 + i, "\n".join([" ".join(some), "", " ".join(rng.permutation(words)[:6])])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    wanted = _late(rows)
    assert {k: r["removed_lines"] for k, r in found.items() if r["removed_lines"]} == wanted
    for key, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if n not in wanted.get(key, [])]
        assert found[key]["text"] == "\n".join(kept)
    out = lines.dedup_lines(odd)
    assert out.columns == [*odd.columns, "removed_lines"] and out.count() == 10
    assert lines.dedup_lines(empty).count() == 0


def test_pipeline_stages(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing",
    ]
    rows = docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        out = pipeline.store(stage(spark, docs, sf_dir), "stage")
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= rows
        docs, rows = out, out.count()
    assert pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").distinct().count() == rows


def test_line_dedup_of_long_and_rewritten_lines(spark):
    """Near the threshold at all lengths; other case, order, repeats and spacing make the same set."""
    rng = np.random.default_rng(5)
    rows = []
    for n in (1, 4, 5, 9, 40, 129, 300):
        base = [f"{n}x{i}" for i in range(n)]
        rows.append((len(rows), " ".join(base)))
        for changed in sorted({0, n // 9 - 1, n // 9, n // 9 + 1, n // 5, n // 5 + 1} & set(range(n + 1))):
            some = [f"{n}y{changed}z{i}" if i < changed else w for i, w in enumerate(rng.permutation(base))]
            rows.append((len(rows), "  ".join(some).upper() + " " + some[0]))
            rows.append((len(rows), " ".join(some[changed:])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["removed_lines"] for r in lines.dedup_lines(df).collect()}
    assert {k: v for k, v in found.items() if v} == _late(rows)


def left_by(spark, work):
    """The tables with rows that *work* leaves in the shared folder, by name."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("*"))
    work()
    new = [p for p in folder.glob("*") if p not in before and list(p.glob("*.parquet"))]
    return sorted(p.name.rsplit("-", 1)[0] for p in new if not spark.read.parquet(str(p)).isEmpty())


def test_line_dedup_and_pipeline_leave_what_is_read_later(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert left_by(spark, lambda: lines.later_matches(docs)) == ["late_lines"]
    found = left_by(spark, lambda: pipeline.run(spark, sf_dir).count())
    assert "benchmark_decontamination" in found
    assert not {"classes", "late_lines", "line_dedup", "quality_classifier", "simhash_near_dedup", "index"} & set(found)


def test_line_dedup_shuffles_only_what_may_be_settled(spark):
    """Numbers of classes are right, and all but the settled ones and a few others reach them without a join."""
    rows = [(7 * i, 3, i, -i, [i, i + 1]) for i in range(3000)]
    classes = spark.createDataFrame(rows, "id bigint, size int, every bigint, upper bigint, prefix array<bigint>")
    gone = {7 * i for i in range(0, 3000, 300)}
    settled = spark.createDataFrame([(i,) for i in gone], "a bigint")
    found = {r["every"]: r["id"] for r in lines._numbered(classes, settled).collect()}
    assert found == {i: 2 * n + (n not in gone) for n, _, i, *_ in rows}
    marked = with_hit(classes, "hit", F.xxhash64("id"), settled.select(F.xxhash64("a")))
    hit = {r["id"] for r in marked.filter("hit").collect()}
    assert gone <= hit and len(hit) < 20
    assert with_hit(classes, "hit", F.xxhash64("id"), settled.filter("false")).filter("hit").count() == 0


def test_line_dedup_finds_few_lines_among_many_texts(spark):
    """Of many texts few hold similar lines, so that the filters leave out most of them; equal lines go without a pair."""
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(10))) for i in range(400)]
    rows += [(1000, "one two three four five six\nlast"), (1001, "six five four three two one"), (1002, "last")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["removed_lines"] for r in lines.dedup_lines(df).collect()}
    assert {k: v for k, v in found.items() if v} == {1001: [0], 1002: [0]} == _late(rows)
