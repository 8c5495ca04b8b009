"""Chat logs, the trie of conversations and the filter audit against plain code, on odd rows."""
import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lettera.llm import audit, chat, prefix_trie, queries
from lettera.llm.common import NO_ID
from lettera.llm.turns import numbered

EVENT = "conv_id long, seq long, kind string, turn long, role string, text string, log string, cut long, again long"
CHAT = "conv_id long, turn long, role string, text string, place long, span long, block long, x1 string"


def log(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], EVENT)


def plain_fold(rows):
    """The log in its order, event by event."""
    value = lambda x: NO_ID if x is None else x
    rows = sorted({(value(c), value(s), k, value(t), r, x) for c, s, k, t, r, x in rows if k in ("start", "delta", "edit", "regenerate")},
                  key=lambda r: (r[0], r[1], r[2], r[4] is not None, r[4] or "", r[5] is not None, r[5] or ""))
    found = {}
    for conv, _, kind, turn, role, text in rows:
        m = found.setdefault(conv, {})
        if kind == "regenerate":
            for later in [t for t in m if t > turn]:
                del m[later]
        said = m.setdefault(turn, ["", ""])
        said[0] = said[0] if role is None else role
        said[1] = {"delta": said[1] + (text or ""), "regenerate": ""}.get(kind, text or "")
    return {(c, t, *said) for c, m in found.items() for t, said in m.items()}


def test_fold_of_a_log(spark):
    rows = [(1, 0, "start", 0, "user", None), (1, 1, "delta", 0, None, "Hel"), (1, 2, "delta", 0, None, "lo"), (1, 3, "start", 1, "assistant", None),
            (1, 4, "delta", 1, None, "bad"), (1, 5, "start", 2, "user", "why"), (1, 6, "regenerate", 1, None, None), (1, 7, "delta", 1, None, "good"),
            (1, 7, "delta", 1, None, "good"), (1, 8, "start", 2, "user", "thanks"), (1, 9, "edit", 0, None, "Hello!"), (1, 10, "noise", 0, None, "?"),
            (1, 11, None, 0, None, "?")]
    got = {tuple(r) for r in chat.messages(log(spark, rows)).collect()}
    assert got == {(1, 0, "user", "Hello!"), (1, 1, "assistant", "good"), (1, 2, "user", "thanks")} == plain_fold(rows)


def test_fold_of_random_logs(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None]:
        for seq in range(rng.randrange(1, 30)):
            kind = rng.choices(["start", "delta", "edit", "regenerate", "other", None], [4, 8, 2, 1, 1, 1])[0]
            rows.append((conv, rng.choice([seq, seq, None]) if conv == 3 else seq, kind, rng.choice([0, 1, 2, 3, None]),
                         rng.choice(["user", "assistant", None]), rng.choice(["a", "é<turn>", "", None, "\\n"])))
    rows += rows[:40]
    # a fold keeps the order of events of one seq: kind, role, text; nulls first
    got = {tuple(r) for r in chat.messages(log(spark, rows)).collect()}
    assert got == plain_fold(rows)
    assert chat.messages(log(spark, [])).count() == 0 and chat.format_log(log(spark, [])).count() == 0


ODD_TEXTS = ["", None, "\\### Assistant: </turn> ok", "</turn", "<turn>", "\\", "\\\\l", "\\l", "<<turn></turn>>\n</turn>\n<turn>assistant\n", "é𝒳" * 400, "a\nb\n",
             "\\lturn>", "</turn>" * 50, "w " * 400_000]


def test_rendering_is_reversible(spark):
    rows = [(c, t, role, text) for c, roles in ((1, ["user", "assistant"]), (2, ["assistant"]), (3, ["a\nb\\n<turn>", None, ""])) for t, (role, text) in
            enumerate(itertools.product(roles, ODD_TEXTS))] + [(None, None, None, None), (None, 1, "assistant", "x")]
    found = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        F.coalesce("conv_id", F.lit(NO_ID)).alias("conv_id"), F.coalesce("turn", F.lit(NO_ID)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        want[c].append((role or "", text or ""))
    pieces = chat.rendered(found)
    for part_chars in (chat.PART_CHARS, 1000):
        parts = chat.conversations(pieces, part_chars).collect()
        assert len(parts) == len(want) if part_chars > 1000 else len(parts) > len(want)
        assert all(r.formatted[s.start:s.stop] is not None and s.stop <= len(r.formatted) for r in parts for s in r.loss)
        whole = collections.defaultdict(str)
        for r in sorted(parts, key=lambda r: (r.conv_id, r.part)):
            whole[None if r.conv_id == NO_ID else r.conv_id] += r.formatted
        assert {c: chat.parsed(x) for c, x in whole.items()} == want
        got = {r.conv_id: r for r in chat.read_back(chat.conversations(pieces, part_chars)).collect()}
        for c, turns in want.items():
            learned = "".join(x for role, x in turns if role == "assistant")
            digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
            assert tuple(got[c])[1:] == (len(turns), digest("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), digest(learned), len(whole[c]))
    with pytest.raises(ValueError):
        chat.parsed("<turn>user\nx</turn>\nrest")


def test_turns_are_counted_in_their_order(spark):
    rows = [(c, t, f"r{k}") for c in (1, 2) for k, t in enumerate([5, None, 3000, 1024, -7, 5, 1023, None, -5000])]
    d = spark.createDataFrame(rows, "conv_id long, turn long, x string").withColumn("sig", F.encode("x", "UTF-8"))
    got = numbered(d).collect()
    for c in (1, 2):
        mine = sorted((r for r in got if r.conv_id == c), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, 10))
        assert [(r.turn, r.x) for r in mine] == sorted([(t, x) for k, t, x in rows if k == c], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            said = (role or "", text or "")
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).digest(), said))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    members, ends, texts = collections.defaultdict(list), collections.defaultdict(list), {}
    for c in own:
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    out = {}
    for node, ids in sorted(members.items(), key=lambda x: -len(x[0])):
        kids = [n for n in texts.get(node, [])]
        own_saved = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        leaves, saved = (sum(out[k][5] for k in kids) if kids else 1), own_saved + sum(out[k][6] for k in kids)
        if node:
            texts.setdefault(node[:-1], []).append(node)
        out[node] = (min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids), leaves, saved,
                     hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
    return sorted(map(str, out.values()))


def trie(spark, rows):
    d = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], CHAT)
    return sorted(str(tuple(r)) for r in prefix_trie.trie(*prefix_trie.with_shared_starts(prefix_trie.turns(d))).collect())


def test_trie_equals_plain_code(spark):
    rng = random.Random(8)
    words = ["", None, "a", "é中", "long text " * 5]
    rows = []
    for c in [*range(-12, 60), 2 ** 62]:
        for t in range(rng.choice([1, 2, 3, 8, 9, 16, 17, 40])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(words[:3])))
    rows += [(100 + 5 * i, t, "user", f"same {t % 3}") for i in range(20) for t in range(70 if i % 2 else 33)]        # copies of long ones
    rows += [(300, None, "user", "first"), (300, None, "a", "first"), (300, 4, None, None), (300, 4, None, None), (None, 1, "user", "no conversation")]
    assert trie(spark, rows) == plain_trie(rows)
    assert trie(spark, [(None, 1, "user", "x")]) == [] and trie(spark, []) == []
    only = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 6)]      # no neighbour is there: some lose their only turn
    assert trie(spark, only) == plain_trie(only)


def test_lists_of_many_ids_are_hashed_in_order(spark):
    rows = [(c, 0, "user", "the same") for c in random.Random(1).sample(range(-20_000, 20_000), 9000)]
    assert trie(spark, rows) == plain_trie(rows)


def plain_audit(docs, labels):
    words = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x)
    least = {}
    for i, x, _ in docs:
        if i is not None:
            least[x or ""] = min(i, least.get(x or "", i))
    rows = []
    for i, x, part in docs:
        x = x or ""
        w = words(x)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", x)) > 5 * len(x),
                 "D": bool(re.search("[#$%&*|]", x)), "E": i is not None and i > least[x]}
        mark = [i is not None and any(r[0] == i and r[k] == 1 for r in labels) for k in (1, 2)]
        rows.append((part or "", fails, *mark))
    out = {}
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                total[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(r[1][f] for r in mine) - len(gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in mine),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[-1] = total[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_plain_code(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice(["one", "Two", "three", "four#", "FIVE", "six", "é"] + [f"w{k}" for k in range(60)]) for _ in range(n)) for n in (1, 20, 49, 50, 51, 80, 300)]
    texts = base + [None, "", " \n\t", "word " * 200_000, "A" * 10, "a b " * 50]
    docs = [(rng.choice([*range(60), None]), rng.choice(texts), rng.choice(["big", "big", "s", "", None])) for _ in range(300)]
    docs += docs[:20]
    labels = [(rng.choice([*range(60), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(70)]
    schema = "doc_id long, text string, source string, cell string, n string, key string, part string, good long, bits long"
    d = spark.createDataFrame([(*r, "x", "y", "z", "p", 1, 2) for r in docs], schema)
    m = spark.createDataFrame([(*r, 7, 8) for r in labels], "doc_id long, quality int, toxic int, good long, first long")
    got = audit.audit(d, m).collect()
    want = plain_audit(docs, labels)
    assert len(got) == len(want) == 600 * len({r[2] or "" for r in docs})
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert audit.audit(d.limit(0), m).count() == 0
    assert {tuple(r)[7:9] for r in audit.audit(d, m.limit(0)).collect()} == {(0, 0)}


def test_audit_of_other_filters(spark):
    two = (audit.Filter("X", lambda text, words: F.size(words) > 1), audit.Filter("Y", lambda text, words: text.contains("y")))
    d = spark.createDataFrame([(1, "x y"), (2, "y"), (3, "x x"), (4, "z"), (5, "z")], "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in audit.audit(
        d, spark.createDataFrame([], "doc_id long, quality int, toxic int"), two, "Z").collect()}
    assert len(got) == 18 and got["XYZ", 1] == (3, 2, 0, 9) and got["XYZ", 2] == (2, 1, 1, 9) and got["YXZ", 2] == (2, 1, 1, 9) and got["ZXY", 1] == (4, 1, 0, 6)


def test_queries_add_the_planted_conversation(spark, sf_dir):
    got = {r.conv_id: r for r in queries.op11_chat_format(spark, sf_dir).collect()}
    said = queries.PLANTED[0][3]
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(said) == 26 and got[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
