import hashlib
import random

import pytest

from tidemark.llm import chat


def brute(rows, part=chat.PART_TURNS):
    convs = {}
    for c, t, r, x in {(c, t, r or "", x or "") for c, t, r, x in rows}:
        convs.setdefault(c, []).append((t is not None, t, r, x))
    mark = lambda z: hashlib.md5(f"{z[2]}\0{z[3]}".encode()).hexdigest()
    convs = {c: sorted(v, key=lambda z: (z[0], z[1] or 0, mark(z))) for c, v in convs.items()}
    bare = {c: [z[2:] for z in v] for c, v in convs.items()}
    key = lambda c: (c is None, c or 0)
    out = []
    for c, v in convs.items():
        if any(d != c and bare[d][:len(v)] == bare[c] and (len(bare[d]) > len(v) or key(d) < key(c)) for d in bare):
            continue
        parts = {}
        for k, z in enumerate(v):
            parts.setdefault(k // part, []).append(f"<|{z[2]}|>\n{z[3]}\n<|end|>\n")
        out += [(c, p, len(v), "".join(x)) for p, x in parts.items()]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv", "part", "n_turns", "text").collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn int, role string, text string, conv string, place int").repartition(3)


@pytest.mark.parametrize("part", [2, 256])
def test_agrees_with_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_TURNS", part)
    rng, rows = random.Random(part), []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice("ab")))
    rows += [(100, 0, None, None), (101, 0, "", ""), (102, None, "user", "x"), (102, 3, "user", "y"), (102, 3, "assistant", "y"), (None, 0, "user", "n"), (None, 1, "user", "n"),
             (103, 0, "user", "long " * 5000), (104, 0, "user", "long " * 5000), (104, 700, "user", "later"), (105, -3, "user", "before")]
    rows += rows[:9]
    assert got(chat.render(table(spark, rows))) == brute(rows, part)


def test_a_snapshot_goes_and_a_fork_stays(spark):
    rows = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "a", "b"), (3, 0, "u", "a"), (3, 1, "a", "c"), (4, 0, "u", "a"), (4, 1, "a", "b"), (5, 0, "u", "b")]
    assert sorted(r.conv for r in chat.render(table(spark, rows)).collect()) == [2, 3, 5]


@pytest.mark.parametrize("turn", [None, 5])
def test_a_conversation_of_one_turn_number_is_cut(spark, turn):
    """A third of all rows have one conversation and one turn number: no task numbers them all."""
    rows = [(None, turn, "user", f"text {k * 7919 % 3000}") for k in range(3000)] + [(k // 4 % 40, k % 4, "user", f"w{k % 4}{k // 4 % 40}") for k in range(6000)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        turns = table(spark, rows).selectExpr("conv_id AS conv", "CAST(turn AS long) AS turn", "role", "text")
        hashed = chat.prefix_hashes(turns)
        assert [r.place for r in hashed.where("conv IS NULL").select("place").orderBy("place").collect()] == list(range(1, 3001))
        assert hashed.groupBy("conv", "task").count().agg({"count": "max"}).first()[0] < 1000
        found = got(chat.render(table(spark, rows)))
        assert found == brute(rows) and max(x[3].count("<|end|>") for x in found) == 256 and len([x for x in found if x[0] is None]) == 12
    finally:
        spark.conf.unset(name)


def test_empty(spark):
    assert chat.render(table(spark, [(1, 0, "u", "a")]).limit(0)).collect() == []


def test_sql_agrees_on_odd_rows(spark):
    """Null ids, null and repeated turn numbers mean the same to the query's SQL."""
    import duckdb

    from tidemark.llm.queries import SQL

    rows = [(None, None, "u", "z"), (None, None, "u", "a"), (None, 3, None, "b"), (7, None, "u", "z"), (7, None, "u", "a"), (7, 3, "", "b"), (8, -1, "u", None), (8, 5, "u", "x"),
            (9, -1, "u", ""), (9, 5, "u", "x"), (9, 5, "u", "y")] + [(10, 4, "u", f"t{k}") for k in range(300)]
    conversations = table(spark, rows).selectExpr("conv_id", "CAST(turn AS long) AS turn", "role", "text").toArrow()  # noqa: F841
    want = duckdb.sql(SQL["op5_chat_format"]).fetchall()
    assert sorted(want, key=str) == got(chat.render(table(spark, rows)))
