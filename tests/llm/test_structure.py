"""Prefix trie, structure repair and top-k search against plain versions."""

import collections
import hashlib
import heapq
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from starq.llm import queries, repair, topk, trie

from .conftest import SF_DIR

has_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
CONVERSATIONS = "conv_id long, turn long, role string, text string, depth long, item string, place long, n long"


def name_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def by_conversation(rows, none=""):
    """conv_id: its (turn, role, text) in the order the operators define."""
    out = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = (none if v is None else v for v in (role, text))
            out[conv].append((turn, role, text))
    for turns in out.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], name_of(r[1], r[2])))
    return out


# --- trie -----------------------------------------------------------------------------------------------------------


def plain_nodes(sequences):
    """(conv_id, depth, parent, convs, children, leaves, saved, ends) by grouping every prefix."""
    members = collections.defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = collections.defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = sum(leaves[c] for c in children[prefix]) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        saved[prefix] = own + sum(saved[c] for c in children[prefix])
    out = []
    for prefix, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(prefix))
        out.append((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(children[prefix]),
            leaves[prefix], saved[prefix], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def nodes(df):
    return sorted(map(tuple, df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ).collect()), key=str)


def plain_rebuilt(conversations):
    out = {}
    for conv, turns in conversations.items():
        h = zlib.crc32(str(conv).encode()) % 6
        plain = [(role, text) for _, role, text in turns]
        head = [(role, text) for _, role, text in conversations.get(conv - conv % 100, [])][:h]
        out[conv] = head + plain[h:]
    return out


@pytest.mark.parametrize("limits", [{}, {"turns": 40, "per_task": 9, "contracted": 6}, {"turns": 10, "per_task": 3, "contracted": 7}])
def test_trie(session, limits):
    rng = random.Random(4)
    texts = ["a", "bb", "", None, "é😀", "a b"]
    rows = []
    for conv in range(120):
        turns = [(t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.choice([1, 2, 3, 5, 12]))]
        rows += [(conv, *t) for t in turns]
    rows += [(c, t, "user", "copy") for c in range(200, 330) for t in range(3)]  # a large group of copies
    rows += [(400, t, "user", "copy") for t in range(300)] + [(401, t, "user", "copy") for t in range(299)]  # long, one a prefix
    rows += [(500, None, "user", "x"), (500, 1, "user", "x"), (500, 1, "user", "x"), (500, None, None, None), (None, 0, "user", "x")]
    rows = [(*r, 9, "i", 8, 7) for r in rows]
    table = session.createDataFrame(rows, CONVERSATIONS).repartition(7)
    plain = {c: [(role, text) for _, role, text in turns] for c, turns in by_conversation(rows).items()}
    assert nodes(trie.nodes(trie.sequences(table), **limits)) == plain_nodes(plain)


def test_trie_without_rows(session):
    none = session.createDataFrame([], CONVERSATIONS)
    assert trie.nodes(trie.sequences(none)).count() == 0
    only = session.createDataFrame([(5, 0, "u", "abc", 1, "", 1, 1)], CONVERSATIONS)
    assert [r[:4] for r in nodes(trie.nodes(trie.sequences(only)))] == [(5, 0, None, 1), (5, 1, 5, 1)]


def test_ids_of_copies_are_joined_over_batches(session):
    """More ids of one sequence than an Arrow batch or a piece holds, over several ranges."""
    table = session.range(30_000).selectExpr("id as conv_id", "array(named_struct('name', cast('0123456789abcdef' as binary), 'chars', 3)) as turns")
    got = trie._ends(table, 5).collect()
    assert [tuple(r) for r in got] == [(0, 30_000, hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest())]


@has_tables
def test_trie_of_the_table(session):
    rows = session.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert nodes(queries.QUERIES["op11_prefix_trie"](session, SF_DIR)) == plain_nodes(plain_rebuilt(by_conversation(rows)))


def test_rebuilt_conversations(session):
    """Heads longer than the base, absent bases, and conversations that end up without turns."""
    rows = [(c, t, "user", f"{c}/{t}", 1, "", 1, 1) for c in [*range(90, 130), *range(200, 230), *range(305, 330)] for t in range(c % 7 + 1)]
    table = session.createDataFrame(rows, CONVERSATIONS)
    plain = plain_rebuilt(by_conversation(rows))
    assert any(not turns for turns in plain.values())
    assert nodes(trie.nodes(queries.rebuilt(table))) == plain_nodes(plain)


# --- repair ---------------------------------------------------------------------------------------------------------


def dijkstra(initials, faults):
    """Cost and ASCII-least edits by a plain search over (cost, path)."""
    heap, settled, n = [(0, "", 0, "")], set(), len(initials)
    while heap:
        cost, path, i, said = heapq.heappop(heap)
        last = said[-1:] or "^"
        if (i, last) in settled:
            continue
        settled.add((i, last))
        if i == n and re.fullmatch(r"\^|a", last):
            return cost, path
        due = {"^": "su", "s": "u", "u": "a", "a": "u"}[last]
        made = due[-1]
        heapq.heappush(heap, (cost + 3, path + "I", i, made))
        if i < n:
            heapq.heappush(heap, (cost + 4, path + "D", i + 1, said))
            if faults[i] != repair.FORCED:
                extra = 3 if faults[i] == repair.TRUNCATED else 0
                if initials[i] in list(due):
                    heapq.heappush(heap, (cost + extra, path + "K", i + 1, initials[i]))
                heapq.heappush(heap, (cost + extra + 3, path + "R", i + 1, made))


def test_cheapest_edits():
    rng = random.Random(3)
    for _ in range(3000):
        n = rng.randrange(9)
        initials = [rng.choice(["s", "u", "a", "u", "a", "x", "", " "]) for _ in range(n)]
        faults = [rng.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        assert repair.cheapest(initials, faults) == dijkstra(initials, faults), (initials, faults)


def test_cheapest_edits_of_a_long_conversation():
    rng = random.Random(5)
    initials, faults = rng.choices("suax", k=100_000), rng.choices([0, 0, 0, 1, 2], k=100_000)
    cost, audit = repair.cheapest(initials, faults)
    assert len(audit.replace("I", "")) == 100_000 and cost >= 4 * faults.count(1)


def faults_of(turns):
    seen, out = set(), []
    for _, role, text in turns:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(turns):
    faults, roles = faults_of(turns), [r[1][:1] for r in turns]
    numbers = [r[0] for r in turns if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    cost, audit = dijkstra(roles, [{None: 0, "truncated": 2}.get(f, 1) for f in faults])
    out, rest = [], iter(turns)
    for edit in audit:
        made = "user" if not out or out[-1][0][:1] != "u" else "assistant"
        if edit == "I":
            out.append((made, ""))
        else:
            _, role, text = next(rest)
            if edit != "D":
                out.append((role if edit == "K" else made, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def plain_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text, turn_text = (" " if v is None else v for v in (role, text, turn))
        fate = zlib.crc32(f"{conv}:{turn_text}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def repairs(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def repaired(table, ids):
    audited = repair.audits(table, ids).cache()
    return audited.join(repair.digests(repair.repaired(table, audited)), "conv_id", "left").fillna(hashlib.sha256(b"").hexdigest(), ["repaired_sha256"])


def test_repair(session):
    rng = random.Random(9)
    texts = ["Yes.", "No!\n ", "cut", "", " \t\x0b", None, "Why? \x1c", " ", "Yes.", "."]
    rows = [
        (c, rng.choice([None, t, t, t + 2]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "ünd"]), rng.choice(texts))
        for c in range(250) for t in range(rng.randrange(1, 9))
    ]
    rows += [(900, t, "system", "Hi.") for t in range(3)] + [(901, None, None, None), (None, 1, "user", "lost.")]
    rows += [(902, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(2_000)]
    table = session.createDataFrame([(*r, 9, "i", 8, 7) for r in rows], CONVERSATIONS).repartition(6)
    ids = session.createDataFrame([(950,), (950,), (901,), (None,)], "conv_id long")
    expected = {c: plain_repair(turns) for c, turns in by_conversation(rows, " ").items()}
    expected[950] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repairs(repaired(table, ids)) == expected
    none = session.createDataFrame([], CONVERSATIONS)
    assert repairs(repaired(none, none)) == {}


def test_damage(session):
    rows = [(c, t, None if c == 3 else "assistant", None if t == 2 else "One. Two! Three?") for c in range(40) for t in [None, *range(6)]]
    got = queries.damaged(session.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(plain_damage(rows))


@has_tables
def test_repair_of_the_table(session):
    rows = [tuple(r) for r in session.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in rows}
    expected |= {c: plain_repair(turns) for c, turns in by_conversation(plain_damage(rows), " ").items()}
    assert repairs(queries.QUERIES["op12_structure_repair"](session, SF_DIR)) == expected


# --- top k ----------------------------------------------------------------------------------------------------------


def plain_top(rows, every=20, k=20):
    usable = [
        (i, [math.floor(64 * x) for x in v]) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (query, q) in enumerate(usable):
        if query % every == 0:
            scored = sorted((-sum(map(int.__mul__, q, v)), i) for b, (i, v) in enumerate(usable) if a != b)[:k]
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


VECTORS = "vec_id long, embedding array<float>, row long, chunk int, ids string, scores string"


def test_top(session, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=7).astype(np.float32)]) for i in range(500)]
    vectors += [(i, vectors[3][1]) for i in range(500, 900)]  # many copies: ties by id
    vectors += [(900, None), (920, [1.0, None]), (940, [float("nan")] * 7), (960, [float("inf")] * 7), (980, []), (1000, [0.5, -0.25]), (None, [1.0] * 7)]
    vectors += [vectors[20], vectors[20], (1020, [3e5] * 7)]  # repeated rows of a query id; large numbers
    table = session.createDataFrame([(*v, 1, 2, "i", "s") for v in vectors], VECTORS).repartition(5)
    for block, chunk, slice_ in ((64, 2048, 4096), (8, 50, 3)):
        monkeypatch.setattr(topk, "BLOCK", block)
        monkeypatch.setattr(topk, "CHUNK", chunk)
        monkeypatch.setattr(topk, "SLICE", slice_)
        assert found(topk.top(table, "vec_id % 20 = 0")) == plain_top(vectors)


def test_top_of_few(session):
    assert found(topk.top(session.createDataFrame([], VECTORS), "vec_id % 20 = 0")) == []
    few = [(20, [1.0, 0.0], 1, 1, "", ""), (3, [0.5, 0.5], 1, 1, "", ""), (7, None, 1, 1, "", "")]
    assert found(topk.top(session.createDataFrame(few, VECTORS), "vec_id % 20 = 0")) == [(20, 1, 3, 64 * 32)]
    assert found(topk.top(session.createDataFrame(few[1:], VECTORS), "vec_id % 20 = 0")) == []


def test_blocks_below_the_kth_are_not_scored():
    """Sorted clusters: a query opens the blocks of its own cluster only."""
    opened = []
    chunk = topk._Chunk(2)
    for b, centre in enumerate(([100, 0], [0, 100], [-100, 0])):
        v = np.array([[centre[0] + i, centre[1]] for i in range(5)], dtype=np.int64)
        ids = np.arange(5, dtype=np.int64) + 5 * b
        chunk.add(ids.tobytes(), ids.tobytes(), v.tobytes(), v.max(axis=0).tobytes(), v.min(axis=0).tobytes(), int(ids.min()))
    best = topk._Best(3)
    add = best.add
    best.add = lambda ids, scores: (opened.extend(ids), add(ids, scores))
    chunk.search(np.array([[10, 0]]), [-1], [best])
    assert sorted(opened) == [0, 1, 2, 3, 4] and list(best.ids) == [4, 3, 2]


@has_tables
def test_top_of_the_table(session):
    rows = session.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert found(queries.QUERIES["op13_block_topk"](session, SF_DIR)) == plain_top(rows)
