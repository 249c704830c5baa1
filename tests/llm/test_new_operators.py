"""Source divergence, sharding and the prefix trie: against brute force, and on nulls, ties, repeated rows, long texts and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from brute import words
from pyspark.sql import functions as F

from tracelake.llm import divergence, sharding, trie


def _terms(text):
    return [t for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]


def _audit(rows, least, top):
    rows = [(_terms(t), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == lang]
        df = Counter(t for r in own for t in set(r[0]))
        kept = sorted(t for t in df if df[t] >= least)
        sources = sorted({r[2] for r in own}, key=lambda s: s.encode())
        counts = {s: Counter(t for r in own if r[2] == s for t in r[0] if t in set(kept)) for s in sources}
        counts[None] = sum(counts.values(), Counter())
        share = {s: {t: 1 + (10**9 * (c[t] + 5)) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in counts.items()}
        for s in sources:
            pair = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(share[s][t] - share[None][t], t) for t in kept if counts[s][t] and share[s][t] > share[None][t]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdeéßÀ", k=rng.randint(1, 5))) for _ in range(120)]
    rows = []
    for i in range(260):
        w = rng.choices(vocabulary[: 40 + i % 9 * 10], k=rng.randint(0, 60))
        rows.append((rng.choice([" ", "-", "\n\t"]).join(w).upper() if i % 5 == 0 else " ".join(w), ["en", "fr", None][i % 3], [None, "a", "b", "é"][i % 4]))
    rows += [(None, "en", "a"), ("", "xx", "alone"), ("123 --- !", "xx", "other"), ("ab " * 30_000, "en", "long"), ("z" * 200_000, "en", "long")] + [("ab cd", "en", "rep")] * 40
    return rows + [("y" * 100 + " ab", "en", "long")] * 35


@pytest.mark.parametrize("bounds", [{}, {"AUTOMATON_TERMS": 5}, {"AUTOMATON_CHARS": 40, "SOURCES_TOGETHER": 2, "TERMS_TOGETHER": 7}])
def test_divergence(spark, corpus, monkeypatch, bounds):
    """Whatever the automata hold, and however sources and terms are put together."""
    for name, value in bounds.items():
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in corpus], "text string, lang string, source string, term int, place int, n int").repartition(5)
    got = sorted(tuple(r) for r in divergence.audit(docs, least=20, top=7).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == _audit(corpus, 20, 7) and any(r[0] == "xx" and r[4] == 0 for r in got)
    assert not bounds or divergence.audit(docs.where("false")).collect() == []


def _jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def _key(i):
    return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("shards", [1, 2, 24, 39, 40, 700])
def test_shards_are_those_of_the_jump_hash(spark, shards):
    keys = spark.range(-50, 600).select(F.when(F.col("id") != 3, F.col("id")).alias("doc_id"), F.lit(1).alias("shard"))
    for r in sharding.placed(keys, shards).collect():
        assert (r.shard, r.grown_shard) == (_jump(_key(r.doc_id), shards), _jump(_key(r.doc_id), shards + 1)) and r.grown_shard in (r.shard, shards)


def test_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FILLED", 7)
    rows = [(i, f"text {i} é") for i in range(200)] + [(None, None), (None, ""), (None, "x"), (5, "other")] + [(77, "hot")] * 100 + [(9, "a" * 300_000)]
    docs = spark.createDataFrame([(*r, 4, 5) for r in rows], "doc_id long, text string, slot int, n int")
    found = []
    for n in (1, 9):
        got = sharding.numbered(docs.repartition(n)).collect()
        assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
        for shard in range(24):
            assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
        assert all(r.shard == _jump(_key(r.doc_id), 24) and r.law == "key" for r in got)
        found.append(sorted(map(tuple, got), key=str))
    assert found[0] == found[1] and sharding.numbered(docs.where("false")).collect() == []


def test_shards_as_files(spark, tmp_path):
    docs = spark.createDataFrame([(i % 40, f"t{i}") for i in range(100)], "doc_id long, text string")
    sharding.write(docs, str(tmp_path / "out"), 5, files=2)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i % 40, f"t{i}") for i in range(100)) and all(r.shard == _jump(_key(r.doc_id), 5) for r in back)


def _trie(rows):
    digest = lambda role, text: hashlib.sha256((str(len(role.encode())) + ":" + role + text).encode()).digest()
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", digest(role or "", text or ""), text or ""))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    full = {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + own[c][h:] for c in own}
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for seq, own_members in members.items():
        below = [u for u in members if u[: len(seq)] == seq]
        kids = [u for u in below if len(u) == len(seq) + 1]
        ends = ",".join(str(c) for c in sorted(own_members) if len(full[c]) == len(seq))
        leaves = sum(not any(len(v) == len(u) + 1 and v[: len(u)] == u for v in below) for u in below)
        saved = sum((len(members[u]) - 1) * len(words(u[-1][1])) for u in below if u)
        out.append((min(own_members), len(seq), min(members[seq[:-1]]) if seq else None, len(own_members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie(spark):
    rng = random.Random(11)
    rows = [(None, 1, "user", "of nobody")]
    for c in range(75):
        for turn in range(rng.randint(1, 7)):
            text = rng.choice(["hello there", "hello", None, "", "a b\tc", "é ß"]) if turn < 4 else f"own {c % 3} words"
            rows.append((c if c < 70 else 1000 + c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None, ""]), text))
    rows += [(20, 3, "user", "again")] * 3 + [(41, i, "user", "deep " + str(i % 2)) for i in range(10, 75)] + [(43, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id long, turn long, role string, text string, node int, name int").repartition(6)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in trie.nodes(df).select(*columns).collect()), key=str) == _trie(rows)
    assert trie.nodes(df.where("false")).collect() == []


def test_trie_of_conversations_without_turns(spark):
    """Conversation 21 takes none of an absent conversation's turns and leaves out its only one; so it is a member of the root alone."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    df = spark.createDataFrame([(c, 0, "user", "x y")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in trie.nodes(df).collect()] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
