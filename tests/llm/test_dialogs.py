"""Conversation repair against a search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pandas as pd
import pytest

from medloom.llm import dialogs

SCHEMA = "conv_id long, turn long, role string, text string, key string, times int, cost int"


def conversations(n, seed):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        turn = r.randint(0, 3)
        for k in range(r.choice([0, 1, 2, 3, 5, 8, 13])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]) if r.random() < 0.4 else ["user", "assistant"][k % 2]
            text = r.choice(["Yes.", "no", "  ", "", None, "Why?\n", "well! so", "ok.", f"line {k}.", f"é{k}!\t"])
            rows.append((c, turn if r.random() < 0.95 else None, role, text))
            turn += r.choice([1, 1, 1, 2, 4])
    return rows


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        mine = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine.extend([(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1))
    return {c: of(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, md5(*r[1:])))) for c, x in convs.items()}


def of(rows):
    seen, kinds = set(), []
    for _, role, text in rows:
        last = re.findall("[^\x20\x09-\x0d]", text)
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    move = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, q, put):
        """Least (cost, audit, lines) of what is left; `put` turns were put in at this place."""
        out = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        if put < 4:
            for x, role in (("u", "user"), ("a", "assistant")):
                if (q, x) in move:
                    c, a, t = best(i, x, put + 1)
                    out.append((c + 2, "I" + a, (f"{role}:",) + t))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, t = best(i + 1, q, 0)
            out.append((c + 3, "D" + a, t))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                if (q, role[:1]) in move:
                    c, a, t = best(i + 1, role[:1], 0)
                    out.append((c + more, "K" + a, (f"{role}:{text}",) + t))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (q, x) in move:
                        c, a, t = best(i + 1, x, 0)
                        out.append((c + 2 + more, "R" + a, (f"{name}:{text}",) + t))
        return min(out, key=lambda x: x[:2]) if out else (10 ** 9, "", ())

    cost, audit, lines = best(0, "", 0)
    turns = {r[0] for r in rows} - {None}
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def test_repairs_are_the_cheapest_and_least(spark):
    rows = conversations(300, 1)
    rows += [(None, t, "user", "hm.") for t in (0, 1, 1, None)] + [(9000, t, "assistant", f"long {t}.") for t in range(60)] + [(9001, 5, "user", "same")] * 40
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA).repartition(6)
    got = dialogs.repair_damaged(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute(rows)


def test_nothing_in_nothing_out(spark):
    assert dialogs.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block,batch", [(1, 1), (3, 2), (7, 50), (1000, 1000)])
def test_blocks_and_batches_change_nothing(monkeypatch, block, batch):
    """The two streams without Spark: every cut into blocks and batches gives one result."""
    monkeypatch.setattr(dialogs, "BLOCK", block)
    r = random.Random(4)
    rows = [(f"={c}", True, t, bytes([t]), r.choice(["user", "assistant", "system", "tool"]), f"t{t}" + r.choice(".x")) for c in range(30) for t in range(r.randint(1, 40))]
    cut = lambda x, names: [pd.DataFrame(x[k:k + batch], columns=names) for k in range(0, len(x), batch)]
    rows.sort(key=lambda x: (x[0], -x[2]))
    code = {"u": 2, "a": 3, "s": 1, "t": 0}
    one = [(*x[:4], code[x[4][0]], False, x[5][-1] != ".", False, 1) for x in rows]
    blocks = pd.concat(dialogs.back_pointers(iter(cut(one, list("abcdefghi"))))).values.tolist()
    two = [(*x[:4], 1, x[4], x[5], 1, None, 0, 0, 0, 0, 0) for x in rows] + [(*b[:4], 0, "", "", 0, *b[4:]) for b in blocks]
    two.sort(key=lambda x: (x[0], x[2], x[4]))
    got = pd.concat(dialogs.repaired(iter(cut(two, list("abcdefghijklmn")))))
    for key, want in ((k, of([(x[2], x[4], x[5]) for x in sorted((x for x in rows if x[0] == k), key=lambda x: x[2])])) for k in {x[0] for x in rows}):
        assert tuple(got[got.key == key].iloc[0])[1:] == want
