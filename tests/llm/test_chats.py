"""Chat trees, repair of conversations and the Merkle manifest, against plain versions of each."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

import public_tokenizers
from comparing import duck, same
from tidewater.llm import chat, earley, manifest, queries, repair

TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
CLASHES = ["node", "start", "path", "uid", "token", "first", "same", "depth", "owner", "at", "whole", "tree", "claim", "audit"]


def sha(x):
    return sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def turns():
    rng, odd = random.Random(3), "<|im_end|>\n<|im_start|>assistant\n<|endoftext|> <\\| <\\\\| <| \\n é日本"
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes!"), (2, 0, "user", "Hello."), (2, 1, "assistant", "No."), (2, 2, "user", "Hello.")]
    rows += [(3, 0, "user", "Hello."), (3, 1, "assistant", "Yes!"), (4, 0, "system", odd), (4, 1, "user", odd), (4, 2, "assistant", odd + "\n")]
    rows += [(5, 0, None, None), (5, None, "user", "x"), (5, 7, "assistant", ""), (5, 7, "assistant", "tie."), (5, 7, "", "tie."), (6, 3, "tool\n\\n<|x", "  \n\t "), (None, 1, "user", "who?"), (None, None, None, "a")]
    rows += [(7, 0, "user", "w. " * 40_000), (7, 1, "user", "w. " * 40_000), (8, 0, "user", "Hello."), (8, 0, "user", "Hello.")]
    for c in range(20, 60):
        rows += [(c, t, rng.choice(["user", "assistant", "assistant", "user", "system", "bot"]), rng.choice(["Hello.", "Yes!", "No.", "and", "", "Why?"])) for t in range(rng.randint(1, 9))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(300)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, turns):
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in turns], schema)


def by_conversation(turns, null, tie):
    out = {}
    for c, t, r, x in turns:
        out.setdefault(c, []).append((t, null if r is None else r, null if x is None else x))
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], tie(r)))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_chat_trees(spark, frame, turns, tmp_path, parts):
    path = f"file://{tmp_path}/chat"
    chat.write(frame.repartition(parts), path, TOKENIZER, PATTERN)
    convs = by_conversation(turns, "", lambda r: sha(r[2]))
    prefixes = {tuple((r, x) for _, r, x in rows[: k + 1]) for rows in convs.values() for k in range(len(rows))}
    nodes = sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: r.start)
    assert len(nodes) == len(prefixes)  # every shared turn once
    assert [n.start for n in nodes] == list(itertools.accumulate([0] + [n.n_tokens for n in nodes[:-1]]))
    at = {n.start: n for n in nodes}
    paths = {}
    for r in spark.read.parquet(f"{path}/paths").collect():
        paths.setdefault(r.conv_id, {})[r.depth] = r.start
    said = {}
    for r in chat.read(spark, path, TOKENIZER, PATTERN).collect():
        said.setdefault(r.conv_id, {})[r.depth] = r
    assert set(paths) == set(said) == set(convs)
    spans = {}
    for c, rows in convs.items():
        assert [(said[c][d].role, said[c][d].text) for d in range(len(rows))] == [(r, x) for _, r, x in rows]
        assert all(said[c][d].loss == (x if r == "assistant" else "") for d, (_, r, x) in enumerate(rows))
        assert len(paths[c]) == len(rows)
        seen = set()
        for d in range(len(rows)):
            n = at[paths[c][d]]
            assert n.tree == paths[c][0] and n.position == len(seen)
            got = [i for a in n.ancestors for i in range(a["from"], a["to"])]
            assert len(got) == len(set(got)) and set(got) == seen
            assert all(a["to"] < b["from"] for a, b in itertools.pairwise(n.ancestors))
            seen |= set(range(n.start, n.start + n.n_tokens))
            spans.setdefault(n.start, set()).add(tuple(paths[c][k] for k in range(d + 1)))
    assert all(len(x) == 1 for x in spans.values())
    # Depth-first: a node's subtree is one interval.
    for start, (p,) in ((k, tuple(v)) for k, v in spans.items()):
        below = sorted(k for k, v in spans.items() if next(iter(v))[: len(p)] == p)
        order = sorted(spans)
        i = order.index(start)
        assert below == order[i : i + len(below)]


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "|", "\\", "<|im_end|>", "a", "\n", "n"]) for _ in range(rng.randint(0, 9)))
        assert "<|" not in chat.escaped(text) and chat.unescaped(chat.escaped(text)) == text
        assert chat.parsed(chat.header(text) + chat.escaped(text) + chat.END) == (text, text)


def test_chat_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    convs = by_conversation([*rows, (-1, 0, "user", queries.CONTROL), (-1, 1, "assistant", queries.CONTROL)], "", lambda r: r[2])
    got = {r.conv_id: r for r in queries.op11_chat_tree(spark, sf_dir).collect()}
    assert set(got) == set(convs)
    for c, ts in convs.items():
        loss = "".join(x for _, r, x in ts if r == "assistant")
        full = "".join(chat.header(r) + chat.escaped(x) + chat.END for _, r, x in ts)
        assert tuple(got[c]) == (c, len(ts), sha("".join(f"{r}\n{x}\n" for _, r, x in ts)), len(loss), sha(loss), len(full))


def test_empty_conversations(spark, frame, tmp_path):
    none = frame.filter("false")
    chat.write(none, f"file://{tmp_path}/none", TOKENIZER, PATTERN)
    assert chat.digests(chat.read(spark, f"file://{tmp_path}/none", TOKENIZER, PATTERN)).collect() == []
    assert repair.digests(repair.repair(repair.damaged(none), none)).collect() == []
    assert [r.asDict() for r in repair.digests(repair.repair(none, frame.filter("conv_id = 1"))).collect()] == [dict(conv_id=1, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=sha(""))]


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def roles_after(tokens, audit, choice):
    """Initials that an audit gives, reroles and insertions as chosen; None if it can't be."""
    out, i, choice = "", 0, iter(choice)
    for e in audit:
        if e == "I":
            out += next(choice)
            continue
        if i == len(tokens):
            return None
        t, i = tokens[i], i + 1
        if e != "D" and t in "bd":
            return None
        out += "" if e == "D" else t.lower() if e == "K" else next(choice)
    return out if i == len(tokens) else None


def cheapest(tokens):
    """Every string of edits up to a length, by plain enumeration."""
    best = None
    for n in range(len(tokens), len(tokens) + 4):
        for audit in map("".join, itertools.product("DIKR", repeat=n)):
            if n - audit.count("I") != len(tokens):
                continue
            kept = [t for t, e in zip(tokens, [e for e in audit if e != "I"], strict=True) if e != "D"]
            cost = 4 * audit.count("D") + 3 * (audit.count("I") + audit.count("R")) + 3 * sum(map(str.isupper, kept))
            if best is not None and (cost, audit) >= best:
                continue
            if any((r := roles_after(tokens, audit, c)) is not None and legal(r) for c in itertools.product("ua", repeat=audit.count("R") + audit.count("I"))):
                best = cost, audit
    return best


def test_parses_are_the_cheapest():
    rng = random.Random(2)
    every = ["", *"suaxSUAXbd", *map("".join, itertools.product("suaAbx", repeat=2)), *("".join(rng.choice("suaxSUAXbd") for _ in range(rng.choice([3, 3, 4]))) for _ in range(60))]
    for t in every:
        assert earley.parse(repair.GRAMMAR, t) == cheapest(t), t


def test_long_parses_put_the_common_beginning_aside(monkeypatch):
    rng = random.Random(4)
    t = "".join(rng.choice("suaxUAbduauaua") for _ in range(2500))
    with_aside = earley.parse(repair.GRAMMAR, t)
    monkeypatch.setattr(earley, "ASIDE", 10**9)
    assert earley.parse(repair.GRAMMAR, t) == with_aside and len(with_aside[1]) >= 2500


def repaired(rows):
    """Report and repaired turns of one conversation's rows in order, by the contract's words."""
    seen, tokens, initials = set(), "", [r[:1] or " " for _, r, _ in rows]
    for _, r, x in rows:
        y, k = x.strip(repair.SPACE), r[:1] if r[:1] in tuple("sua") else "x"
        tokens += "b" if not y else "d" if (r, x) in seen else k if y[-1] in ".!?" else k.upper()
        seen.add((r, x))
    numbers = [t for t, _, _ in rows if t is not None]
    cost, audit = earley.parse(repair.GRAMMAR, tokens)
    out, left, last = [], iter(rows), ""
    for e in audit:
        t, r, x = (None, "", "") if e == "I" else next(left)
        if e == "D":
            continue
        r = r if e == "K" else "assistant" if last == "u" else "user"
        out.append(f"{r}:{x}")
        last = r[:1]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return gaps, tokens.count("b"), tokens.count("d"), sum(map(str.isupper, tokens)), illegal, cost, audit, sha("\n".join(out))


def broken(turns):
    for c, t, r, x in turns:
        k, r, x = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20, " " if r is None else r, " " if x is None else x
        r, x = "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        yield from [(c, t, r, x)] * (0 if k == 0 else 2 if k == 3 else 1)


@pytest.mark.parametrize("parts", [1, 5])
def test_repair_of_odd_rows(frame, turns, parts):
    got = {r.conv_id: tuple(r)[1:] for r in repair.digests(repair.repair(repair.damaged(frame.repartition(parts)), frame)).collect()}
    tie = lambda r: sha(f"{len(r[1])}:{r[1]}{r[2]}")
    want = by_conversation(broken(turns), " ", tie)
    assert set(got) == {r[0] for r in turns}
    for c in got:
        assert got[c] == repaired(want.get(c, [])), c


def test_repaired_turns_are_legal(frame):
    out = {}
    for r in repair.repair(repair.damaged(frame)).filter("pos > 0 and edit <> 'D'").collect():
        out.setdefault(r.conv_id, []).append((r.pos, r.role[0]))
    assert len(out) > 30 and all(legal("".join(i for _, i in sorted(rows))) for rows in out.values())


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof and folded root of rows, level by level."""

    def h(*x):
        return sha("".join(x))

    def leaf(r, more=0):
        doc_id, text, lang, source, n = r
        n = n if n is None else n + more
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])

    def grow(level, paths, groups):
        while len(level) > 1:
            nxt = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
            for i in range(len(level)):
                j = i ^ 1
                for p in groups[i]:
                    paths[p].append("-" if j >= len(level) else ("L" if j < i else "R") + level[j])
            groups = [groups[i] + (groups[i + 1] if i + 1 < len(level) else []) for i in range(0, len(level), 2)]
            level = nxt
        return level[0], sum(groups, [])

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order, paths, subs, groups = [], [], [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        at = len(order)
        order += mine
        paths += [[] for _ in mine]
        sub, ids = grow([leaf(r) for r in mine], paths, [[at + i] for i in range(len(mine))])
        subs.append((lang, sub))
        groups.append(ids)
    root, _ = grow([s for _, s in subs], paths, groups)
    subs = dict(subs)
    for r, p in zip(order, paths, strict=True):
        f = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
        for s in p:
            f = h(f) if s == "-" else h(s[1:], f) if s[0] == "L" else h(f, s[1:])
        yield r[0], leaf(r), subs[r[2]], root, h(*[s[1:] for s in p]), f, f == root


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("levels", "top"), [(1, 1), (1, 3), (2, 2), (10, 4096)])
def test_manifest_of_odd_rows(spark, odd, odd_rows, levels, top):
    out = manifest.proofs(odd, manifest.tampered(), levels, top)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, sha("".join(s[1:] for s in r.proof)), r.folded_root, r.folded_root == r.root) for r in out.collect()]
    want = ordered(plain_manifest(odd_rows))
    assert ordered(got) == want and {r[6] for r in want} == {True, False}


@pytest.mark.parametrize(("levels", "top"), [(1, 4), (2, 16), (10, 4096)])
def test_manifest_of_many_languages(spark, levels, top):
    rng = random.Random(9)
    rows = [(i, f"text {i}", f"l{min(rng.randint(0, 60), rng.randint(0, 60))}", "s", i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    out = manifest.proofs(df, manifest.tampered(), levels, top)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, sha("".join(s[1:] for s in r.proof)), r.folded_root, r.folded_root == r.root) for r in out.collect()]
    assert ordered(got) == ordered(plain_manifest(rows))


def test_manifest_query(spark, sf_dir, empty):
    out = queries.op12_merkle_manifest(spark, sf_dir)
    same(out, duck(sf_dir), manifest.ORACLE)
    assert manifest.digests(empty).collect() == []


def test_own_proofs_verify(odd):
    assert all(r.folded_root == r.root == manifest.folded(r.leaf, r.proof) for r in manifest.proofs(odd, levels=2, top=2).collect())


@pytest.mark.parametrize("name", ["op11_chat_tree", "op13_repair_turns"])
def test_conversation_queries_say_what_their_sql_says(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLE[name])
