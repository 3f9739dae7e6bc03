"""Repairs against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

from codeloom.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def searched(signature):
    """Cheapest first, then ASCII-least, over whole audits; no use of the automaton's kinds or ranks."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, place, out = heapq.heappop(heap)
        if (place, tail := out[-1:] or "-") in done:
            continue
        if place == len(signature) and GRAMMAR.fullmatch(out):
            return cost, audit
        done.add((place, tail))
        options = [("I", 2, place, x) for x in "ua"]
        if place < len(signature):
            sign = signature[place]
            options.append(("D", 3, place + 1, ""))
            if sign != "-":
                extra = sign.isupper()
                options.append(("K", extra, place + 1, sign.lower()))
                options += [("R", 2 + extra, place + 1, x) for x in "ua"]
        for letter, more, to, new in options:
            if new and (out[-1:], new) not in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                continue
            heapq.heappush(heap, (cost + more, audit + letter, to, out + new))


def plain(rows):
    """Contract counts, audit and hash of one conversation's damaged rows in order."""
    seen, signs, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        solid = SOLID.findall(text)
        sign = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not solid:
            fault, sign = "blank", "-"
        elif (role, text) in seen:
            fault, sign = "duplicate", "-"
        elif solid[-1] not in ".!?":
            fault, sign = "truncated", sign.upper()
        else:
            fault = None
        if fault:
            counts[fault] += 1
        seen.add((role, text))
        signs += sign
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    cost, audit = searched(signs)
    out, left = [], iter(rows)
    for letter in audit:
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((wanted, ""))
            continue
        _, role, text = next(left)
        if letter != "D":
            out.append((role if letter == "K" else wanted, text))
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for own in chats.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return {conv: plain(own) for conv, own in chats.items()}


def test_audits_equal_a_search_over_all_edits():
    path, draw = repair.Path(), random.Random(3)
    short = ["".join(s) for n in range(1, 5) for s in itertools.product("suaxSUAX-", repeat=n)]
    long = ["".join(draw.choice("suauaxUA-") for _ in range(draw.randrange(5, 25))) for _ in range(1500)]
    signatures = sorted({s[::-1] for s in short + long})
    for backwards in signatures:
        assert path.audit(backwards) == searched(backwards[::-1]), backwards[::-1]
        assert path.audit(backwards) == searched(backwards[::-1])
    # Every node once: the distinct suffixes of all signatures.
    assert path.made == len({b[:n] for b in signatures for n in range(1, len(b) + 1)})
    assert len(path.graph.kinds) < 200


def test_conversations_equal_direct_computation(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_repair(plain_damage(rows))
    lost = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in repair.op13(spark, sf).collect()}
    assert got == {c: want.get(c, lost) for c, *_ in rows}


def test_edge_cases(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "Hi."), (2, None, "assistant", "a"), (2, None, "assistant", "a"),
        (3, 5, "user", "One!\x0b "), (3, 9, "user", "Two?"), (3, 9, "user", "Two?"), (3, 10, "assistant", ""),
        (4, 0, "", "Empty role."), (4, 1, "tool", "x"), (4, 2, "User", "Capital."), (4, 3, "system", "late."),
        (None, 0, "user", "Null id."), (None, 1, "assistant", "é "), (5, 0, "system", "Alone."),
        (6, 0, "user", "Long. " * 200_000), (6, 1, "assistant", "word " * 200_000), (7, 2, "user", " \t"),
    ] + [(8, i, "user" if i % 3 else "assistant", f"{i}" + "." * (i % 2)) for i in range(12_000)]
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(*r, "k", 1) for r in rows], schema + ", signature string, nth int")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(table).collect()}
    want = plain_repair([r for r in rows if r[0] != 8])
    assert {c: g for c, g in got.items() if c != 8} == want
    assert len(got[8][6].replace("I", "")) == 12_000
    harmed = repair.damaged(table)
    assert sorted(map(str, (tuple(r) for r in harmed.collect()))) == sorted(map(str, plain_damage(rows)))
    empty = repair.repair(table.where("false"))
    assert empty.collect() == []
    assert empty.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
