import random

import pytest
from pyspark.sql import functions as F

from matchlab.functions.jaro import jaro_similarity
from matchlab.operators.names import _packed, candidate_pairs, canonical_team, fuzzy_left_join, map_values, resolve_lineup, similar_values
from matchlab.operators.teams import local_alias_table


def words(n, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcdeÄz'") for _ in range(rng.randint(1, 9))) for _ in range(n)})


def test_known_similarities():
    assert jaro_similarity("MARTHA", "MARHTA") == pytest.approx(0.944444, abs=1e-6)
    assert jaro_similarity("DIXON", "DICKSONX") == pytest.approx(0.766667, abs=1e-6)
    assert jaro_similarity("abc", "xyz") == 0.0 and jaro_similarity("a", "") == 0.0


@pytest.mark.parametrize("max_dist", [0.0, 0.22, 0.3, 0.45])
def test_prefix_join_loses_no_pair(spark, max_dist):
    left, right = words(120, 1), words(120, 2) + ["abc", "abcd"]
    l, r = (spark.createDataFrame([(w,) for w in v + [None, ""]], "w string") for v in (left, right))
    got = {(x.value, x.value_right): x.distance for x in similar_values(l, r, max_dist).collect()}
    want = {(a, b): 1 - jaro_similarity(a, b) for a in left for b in right if 1 - jaro_similarity(a, b) <= max_dist + 1e-12}
    assert got == pytest.approx(want)


def test_long_and_odd_strings_lose_no_pair(spark):
    rng = random.Random(9)
    base = ["aaaaaaa", "aaaaaab", "baaaaaa", "zzzzzzzzzz", "Ünïcödé", "ünïcöde", "日本語", "日本誤", "o'neil", "oneil", "ONEIL", "mississippi", "misisippi", "x", "xx", "a b c d e f", "0123456789"]
    more = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(5, 14))) for _ in range(150)]
    df = spark.createDataFrame([(w,) for w in sorted({*base, *more})], "w string")
    vocabulary = [r.w for r in df.collect()]
    for max_dist in (0.05, 0.22, 0.32):
        rows = similar_values(df, df, max_dist).collect()
        got = {(x.value, x.value_right) for x in rows}
        assert len(got) == len(rows)
        assert got == {(a, b) for a in vocabulary for b in vocabulary if 1 - jaro_similarity(a, b) <= max_dist + 1e-12}


def test_candidates_are_bounded_by_packed_counts(spark):
    """Of 4000 names against themselves each candidate shares the needed tokens, comes once, and no distance is computed for the rest."""
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("etaoinshrdlucmfwypvbgkjqxz") for _ in range(rng.randint(5, 9))) for _ in range(4000)})
    df = spark.createDataFrame([(w,) for w in names], "w string").repartition(4)
    left, right = (_packed(df.select(F.col("w").alias(c)), c) for c in ("vl", "vr"))
    pairs = candidate_pairs(left, right, 0.15)
    n = pairs.count()
    assert n == pairs.distinct().count() and n < 0.002 * len(names) ** 2
    assert pairs.filter("vl = vr").count() == left.filter("toks IS NOT NULL").count()
    close = similar_values(df, df, 0.15).count()
    assert len(names) <= close <= n


def test_fuzzy_join_keeps_fan_out_and_unmatched(spark):
    left = spark.createDataFrame([(1, "Sebastian", "Kris"), (2, "Nobody", "Xyz"), (3, None, "Kris")], "i int, f string, s string")
    right = spark.createDataFrame([(10, "Sebastian", "Kriss"), (11, "Sebastien", "Kris"), (12, "Zed", "Kris")], "p int, f string, s string")
    out = sorted((r.i, r.p) for r in fuzzy_left_join(left, right, ["s", "f"]).collect() if r.p)
    assert out == [(1, 10), (1, 11)]
    assert {r.i for r in fuzzy_left_join(left, right, ["s", "f"]).filter("p IS NULL").collect()} == {2, 3}
    best = fuzzy_left_join(left, right, ["s", "f"], top=1).filter("p IS NOT NULL").collect()
    # Kris/Kriss differ by 1/15, Sebastian/Sebastien by 2/27
    assert [(r.i, r.p) for r in best] == [(1, 10)]


def test_lineup_resolution(spark):
    lineup = spark.createDataFrame(
        [
            ("KL", "Iro", "Winger", "Sharks"),
            ("Sam", "Hughes", "2nd", "Wests Tigers"),
            ("Ann", "Lee", "Reserve", "Sharks"),
            ("Same", "Name", "Prop", "Sharks"),
            ("Qqq", "Vvv", "Prop", "Sharks"),
        ],
        "firstname string, surname string, position string, team string",
    )
    key = spark.createDataFrame(
        [(1, "Kayal", "Iro"), (2, "Sam", "Hughes"), (3, "Same", "Name"), (4, "Same", "Name")],
        "player_id long, firstname string, surname string",
    )
    games = spark.createDataFrame(
        [("Cronulla-Sutherland Sharks", 7, 1, "home"), ("Wests Tigers", 7, 1, "away")],
        "team_name string, match_id long, round int, team_location string",
    ).withColumn("date", F.lit("2026-04-24").cast("date"))
    out = resolve_lineup(lineup, key, games).collect()
    got = sorted((r.player_id or 0, r.firstname, r.position, r.team_location) for r in out)
    assert got == [
        (0, "Qqq", "Prop", "home"),
        (1, "Kayal", "Wing", "home"),
        (2, "Sam", "Second Row", "away"),
        (3, "Same", "Prop", "home"),
        (4, "Same", "Prop", "home"),
    ]


def test_team_names_and_alias_tables(spark):
    df = spark.createDataFrame([("Wests Tigers",), ("Manly-Warringah Sea Eagles",), ("Sea Eagles",), ("Raiders",), ("x!",)], "t string")
    got = [r.c for r in df.select(canonical_team(F.col("t")).alias("c")).collect()]
    assert got == ["Tigers", "Eagles", "Eagles", "Raiders", "x!"]
    table = local_alias_table(spark, {"Raiders": "R"})
    assert {r.t for r in map_values(df, "t", table).collect()} >= {"R", "x!"}


def test_several_aliases_of_a_value_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    aliases = spark.createDataFrame([("a", "z"), ("a", "y")], "value string, mapped string")
    assert sorted(map(str, (r.x for r in map_values(df, "x", aliases).collect()))) == ["None", "b", "y"]


def test_a_common_surname_alone_pairs_nobody(spark):
    left = spark.createDataFrame([(f"{chr(97 + i % 26) * 5}{i:04d}", "smith") for i in range(400)], "firstname string, surname string")
    right = spark.createDataFrame([(f"{chr(97 + i % 26) * 5}{i:04d}", "smith") for i in range(400)], "firstname string, surname string")
    out = fuzzy_left_join(left, right, ["surname", "firstname"], 0.01)
    rows = out.collect()
    assert len(rows) == 400 and all(r.firstname == r.firstname_right for r in rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in plan


def test_words_of_few_syllables_meet_only_on_their_common_characters(spark):
    """All pairs with the needed common characters, each once, and no others: rare tokens alone would pair nearly everything."""
    from collections import Counter

    from matchlab.operators.names import LEFT_OUT, _lengths, common_pairs, needed

    rng = random.Random(5)
    some = ["an", "th", "er", "on", "en", "tion", "aaaaa", "日本"]
    vocabulary = sorted({"".join(rng.choice(some) for _ in range(rng.randint(1, 7))) for _ in range(500)})
    df = spark.createDataFrame([(w,) for w in vocabulary], "w string").repartition(3)
    for max_dist in (0.05, 0.15):
        k = 3 * (1 - max_dist) - 1

        def near(a, b, k=k):
            need = needed(len(a), len(b), k)
            return max(len(a), len(b)) - need <= LEFT_OUT and (Counter(a) & Counter(b)).total() >= need

        left, right = df.toDF("vl"), df.toDF("vr")
        rows = common_pairs(left, right, _lengths(left, "vl"), _lengths(right, "vr"), max_dist).collect()
        got = {(r.vl, r.vr) for r in rows}
        assert len(got) == len(rows)
        assert got == {(a, b) for a in vocabulary for b in vocabulary if near(a, b)}
        found = {(r.value, r.value_right) for r in similar_values(df, df, max_dist).collect()}
        assert found == {(a, b) for a in vocabulary for b in vocabulary if 1 - jaro_similarity(a, b) <= max_dist + 1e-12}


def test_similarities_side_by_side_equal_one_by_one():
    from matchlab.functions.jaro import jaro_similarities

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcÄ\U0001f600\0") for _ in range(rng.randint(1, 20)))
    a = [word() for _ in range(3000)]
    b = [w if rng.random() < 0.1 else "".join(rng.sample(w, len(w)))[: rng.randint(1, 20)] if rng.random() < 0.5 else word() for w in a]
    assert jaro_similarities(a, b).tolist() == [jaro_similarity(x, y) for x, y in zip(a, b)]
