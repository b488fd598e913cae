"""Conversation repair against a plain search over edits, on the given table and on awkward ones."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from llm_fixtures import save
from tillflow.llm import repair as R

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(name.encode()) % 20
        if d == 1:
            text = ""
        if d == 2:
            text = "".join(c for c in text if c not in ".!?")
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def next_places(place, role):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((place, role))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit, output) over all edits, turn by turn with every reachable place."""
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(3):
            for p, (cost, audit, made) in list(best.items()):
                for role in ("user", "assistant"):
                    q = next_places(p, role[0])
                    if q is not None:
                        new = (cost + 3, audit + "I", (*made, (role, "")))
                        if q not in best or new[:2] < best[q][:2]:
                            best[q] = new
        return best

    best = insert(best)
    for (_, _, role, text), fault in zip(rows, found):
        after = {}

        def put(q, new):
            if q not in after or new[:2] < after[q][:2]:
                after[q] = new
        for p, (cost, audit, made) in best.items():
            put(p, (cost + 4, audit + "D", made))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                q = next_places(p, role[:1])
                if q is not None:
                    put(q, (cost + more, audit + "K", (*made, (role, text))))
                for new_role in ("user", "assistant"):
                    q = next_places(p, new_role[0])
                    if q is not None:
                        put(q, (cost + more + 3, audit + "R", (*made, (new_role, text))))
        best = insert(after)
    return min((best[q] for q in (0, 3) if q in best), key=lambda x: x[:2])


def brute(rows):
    """{conv_id: digest row} of the contract."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        found = faults(turns)
        cost, audit, made = cheapest(turns, found)
        numbers = [r[1] for r in turns if r[1] is not None]
        initials = [r[2][:1] for r in turns]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def run(spark, df):
    got = R.digests(R.repair_conversations(R.damaged(df), copies="copies")).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def compare(spark, rows, df=None):
    got = run(spark, spark.createDataFrame(rows, SCHEMA) if df is None else df)
    assert got == brute(rows)
    return got


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = compare(spark, rows, df)
    assert {"K", "D", "I", "R"} <= set("".join(g[6] for g in got.values()))


def test_the_dynamic_programme_equals_every_edit_string():
    """The plain search itself, and the parse, against all edit strings of short conversations."""
    rng = random.Random(5)
    parser = R.Parser()
    for _ in range(60):
        n = rng.randint(0, 3)
        rows = [(1, i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b", "", "c!"]))
                for i in range(n)]
        found = faults(rows)
        options = []
        for gaps in product(range(3), repeat=n + 1):
            for letters in product("DKR", repeat=n):
                options.append("".join("I" * g + x for g, x in zip(gaps, [*letters, ""])))
        best = None
        for audit in options:
            for roles in product("ua", repeat=audit.count("R") + audit.count("I")):
                cost, text, i, roles = 0, "", 0, list(roles)
                for x in audit:
                    if x == "I":
                        cost, text = cost + 3, text + roles.pop(0)
                        continue
                    fault = found[i]
                    cost += {"D": 4, "K": 0, "R": 3}[x] + 3 * (fault == "truncated" and x != "D")
                    if x != "D" and fault in ("blank", "duplicate"):
                        cost = 10 ** 6
                    text += {"D": "", "K": rows[i][2][:1] or "-", "R": ""}[x] + (roles.pop(0) if x == "R" else "")
                    i += 1
                rest = text[1:] if text[:1] == "s" else text
                fits = (not text) or (len(rest) > 0 and rest == "ua" * (len(rest) // 2) and len(rest) % 2 == 0)
                if fits and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        assert cheapest(rows, found)[:2] == best
        symbols = [(R.GONE, 1) if f in ("blank", "duplicate") else (r[2][:1] + ("t" if f else "f"), 1)
                   for r, f in zip(rows, found)]
        assert parser.best(parser.symbols(symbols)) == best


def random_rows(rng, convs, longest):
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t + rng.choice([0, 0, 0, 1]) if rng.random() < 0.95 else None,
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Oi. ", "sim", "", "  \n", "não!", "fim?\t", "a\x00b.", "ß 中文", None, f"texto {rng.random()}."])))
    return rows


def test_random_conversations_with_ties_repeats_and_nulls(spark):
    rng = random.Random(11)
    rows = random_rows(rng, 60, 9)
    rows += rng.sample(rows, 40) + [(None, 0, "user", "sem id."), (None, None, None, None)]
    rng.shuffle(rows)
    compare(spark, rows)


@pytest.mark.parametrize("span", [2, 3, 16])
def test_long_conversations_over_many_stretches(spark, monkeypatch, span):
    """Conversations longer than a stretch, over several tasks, parse to the same repair."""
    monkeypatch.setattr(R, "SPAN", span)
    rng = random.Random(span)
    rows = random_rows(rng, 4, 150) + [(9, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(300)]
    compare(spark, rows)


def test_a_third_of_all_rows_equal(spark):
    rows = [(1, 0, "user", "igual.")] * 300 + [(2, i, "assistant" if i % 2 else "user", f"v{i}.") for i in range(300)]
    rows += [(i, 0, "user", "Oi.") for i in range(10, 200)] + [(i, 1, "assistant", "Sim.") for i in range(10, 200)]
    got = compare(spark, rows)
    assert got[1][6].count("D") in (299, 300, 599, 600)


def test_all_turns_dropped_and_very_long_text(spark):
    gone = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = gone + [(-1, 0, "user", "palavra " * 60_000 + "."), (-1, 1, "assistant", "ok.")]
    got = compare(spark, rows)
    assert gone and all(got[g[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for g in gone)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(spark, empty) == {}
    rows = random_rows(random.Random(3), 12, 5)
    extra = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "copies", "task", "nth", "cell", "first", "times", "cost", "rows"):
        extra = extra.withColumn(name, F.lit(7))
    compare(spark, rows, extra)


def test_real_output_is_the_repaired_turns(spark, tmp_path):
    rows = [(1, 0, "user", "Oi."), (1, 1, "user", "Sim."), (1, 2, "assistant", "Não.")]
    out = R.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    out.sort(key=lambda r: r["stretch"])
    assert out[0]["audit"] == "KIKK" and out[0]["cost"] == 3
    assert [r["last"] for r in out] == [False] * (len(out) - 1) + [True]
    assert [tuple(x) for r in out for x in r["rows"]] == [("user", "Oi."), ("assistant", ""), ("user", "Sim."), ("assistant", "Não.")]
    folder = save(spark.createDataFrame(rows, SCHEMA), tmp_path, "conversations")
    assert R.op11_repair(spark, folder).count() == 1
