"""Conversation repair: every edit sequence of short conversations, full CYK charts, odd rows, long conversations."""

import hashlib
import random
import re
import zlib
from itertools import product

from cartloom.llm import repair
from cartloom.llm.queries import QUERIES

GOAL = re.compile(r"(s?(ua)+)?\Z")


def fault_of(turns):
    """1 for blank or duplicate, 2 for truncated, 0 else, with the three counts."""
    seen, out, counts = set(), [], [0, 0, 0]
    for role, text in turns:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            counts[kind] += 1
        out.append({None: 0, 0: 1, 1: 1, 2: 2}[kind])
    return out, counts


def by_trying(turns, most=2):
    """(cost, audit, result) over all edits with up to ``most`` insertions between turns."""
    flaws, _ = fault_of(turns)
    best = (2 * len(turns), "D" * len(turns), [])  # all of them deleted

    def go(i, cost, audit, out):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(turns):
            if GOAL.match("".join(r[:1] for r, _ in out)) and (cost, audit) < best[:2]:
                best = (cost, audit, list(out))
        for role in ("user", "assistant"):
            if audit[-most:] != "I" * most:
                go(i, cost + 5, audit + "I", out + [(role, "")])
        if i < len(turns):
            role, text = turns[i]
            go(i + 1, cost + 2, audit + "D", out)
            if flaws[i] != 1:
                more = 5 if flaws[i] == 2 else 0
                if role[:1] in "sua" and role:
                    go(i + 1, cost + more, audit + "K", out + [(role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + more + 1, audit + "R", out + [(new, text)])

    go(0, 0, "", [])
    return best


def plain_cost(turns):
    """(cost, audit) by the ordinary chart: all spans by length, all cuts."""
    flaws, _ = fault_of(turns)
    if not turns:
        return 0, ""
    initial = lambda r: r[:1] if r[:1] in ("s", "u", "a") else "?"
    n = len(turns)
    chart = {(i, i + 1): repair.turn_cell(initial(r), f) for i, ((r, _), f) in enumerate(zip(turns, flaws))}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cell = {}
            for cut in range(i + 1, i + size):
                for k, v in repair.combine(chart[i, cut], chart[cut, i + size]).items():
                    cell[k] = min(cell.get(k, v), v)
            chart[i, i + size] = cell
    whole = chart[0, n]
    return min(v for k, v in whole.items() if k in ((repair.START, repair.START), (repair.START, repair.ASSISTANT)))


def apply(turns, audit):
    out, i, t = [], 0, sum(c != "D" for c in audit)
    for c in audit:
        role = "user" if (len(out) + t) % 2 == 0 else "assistant"
        if c != "D":
            out.append((role, "") if c == "I" else (turns[i][0] if c == "K" else role, turns[i][1]))
        i += c != "I"
    assert i == len(turns)
    return out


def plain(rows):
    """The contract by loops over ``(conv_id, turn, role, text)``."""
    convs = {}
    for c, t, r, x in rows:
        kept = convs.setdefault(c, [])
        r, x = (" " if v is None else v for v in (r, x))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        kept += [] if kind == 0 else [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    out = {}
    for c, kept in convs.items():
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2]))
        turns = [k[1:] for k in kept]
        numbers = [k[0] for k in kept if k[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        _, counts = fault_of(turns)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = plain_cost(turns)
        text = "\n".join(f"{r}:{x}" for r, x in apply(turns, audit))
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_all_edits_of_short_conversations():
    rng = random.Random(5)
    texts = ["Yes.", "no", "", "So!"]
    some = [list(x) for n in (1, 2) for x in product(product(["system", "user", "assistant", "tool", ""], texts), repeat=n)]
    some += [[(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(texts + [f"t{k}.", f"w{k}?"])) for k in range(rng.randint(3, 5))] for _ in range(150)]
    for turns in some:
        cost, audit, out = by_trying(turns)
        assert plain_cost(turns) == (cost, audit), turns
        assert apply(turns, audit) == out
        codes = bytes(4 * "sua?".index(r[:1] if r[:1] in ("s", "u", "a") else "?") + f for (r, _), f in zip(turns, fault_of(turns)[0]))
        cell = repair._parse_codes(codes)
        assert min(v for k, v in cell.items() if k in ((0, 0), (0, 3))) == (cost, audit)


def test_given_conversations(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_repair"](spark, path).collect()}
    assert got == plain(rows)


def test_edges(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hm."), (1, 0, "user", None), (1, 0, None, "a."), (1, 5, "assistant", "b."), (1, 5, "assistant", "b.")]
    rows += [(2, t, "system", f"{t}.") for t in range(9)] + [(3, None, "user", f"{t}.") for t in range(4)] + [(4, 0, "user", "x. \n\t"), (4, 1, "assistant", "é" * 30000 + "?")]
    # ids whose only turn is dropped
    rows += [(c, 0, "user", "Gone.") for c in range(100, 160)]
    turns = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, _id int")
    parsed, fixed = repair.repair(repair.damage(turns))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.digests(turns.select("conv_id").distinct(), parsed, fixed).collect()}
    assert got == plain(rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())
    parsed, fixed = repair.repair(turns.where("false"))
    assert parsed.count() == 0 and fixed.count() == 0


def test_long_conversations_in_levels(spark):
    rng = random.Random(2)
    said = [(rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice([f"t{k}.", f"t{k}", "", "ok."])) for k in range(70)]
    rows = [(c, k, *t) for c in (1, 2) for k, t in enumerate(said[: 70 if c == 1 else 20])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parsed, fixed = repair.repair(turns, span=5)
    fixed = fixed.collect()
    for r in parsed.collect():
        mine = [t for c, _, *t in rows if c == r.conv_id]
        mine = [tuple(t) for t in mine]
        assert (r.cost, r.audit) == plain_cost(mine)
        out = [(f.role, f.text) for f in sorted(fixed, key=lambda f: f.at) if f.conv_id == r.conv_id]
        assert out == apply(mine, r.audit) and GOAL.match("".join(x[0][:1] for x in out))
