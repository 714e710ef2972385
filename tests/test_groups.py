"""Shared-property groups: sizes, pairs, labels and risk rules at their boundaries."""

from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tallygraph.operators.relational import clean_relations, clean_relations_since, shared_members
from tallygraph.plans import group_detection, single_property

RELATION = "user_id BIGINT, val STRING, addtime BIGINT, edge_id BIGINT, node_id BIGINT, sub_rel STRING, rel STRING"
CLASSIFY = (
    "user_id BIGINT, flag INT, last_order_nid BIGINT, if_last_order_success INT, is_duotou INT, "
    "is_high_risk_reject INT, is_blacklist INT, is_overdue INT"
)


def relation_rows(values, rel="phone", repeat=1):
    """``values``: value number -> users."""
    return [
        (user, f"v{node}", 1500000000, node * 1000 + i, node, "s", rel)
        for node, users in values.items()
        for i, user in enumerate(users)
        for _ in range(repeat)
    ]


def relations(spark, values, **kind):
    return spark.createDataFrame(relation_rows(values, **kind), RELATION)


def classified(spark, users, flag=3):
    return spark.createDataFrame([(u, flag, None, 0, 0, 0, 0, 0) for u in users], CLASSIFY)


def test_dirty_rows_are_dropped(spark):
    good = (1, "v", 1500000000, 1, 1, "s", "phone")
    bad = [
        (None, "v", 1500000000, 1, 1, "s", "phone"),
        (1, None, 1500000000, 1, 1, "s", "phone"),
        (1, "", 1500000000, 1, 1, "s", "phone"),
        (1, "NULL", 1500000000, 1, 1, "s", "phone"),
        (1, "v", None, 1, 1, "s", "phone"),
        (1, "v", 1500000000, None, 1, "s", "phone"),
        (1, "v", 1500000000, 1, None, "s", "phone"),
    ]
    df = spark.createDataFrame([good, *bad, (1, "v", 1500000000, 1, 1, "s", "ip")], RELATION)
    assert clean_relations(df, "phone").count() == 1
    assert clean_relations_since(df, "2017-07-14").count() == 1
    assert clean_relations_since(df, "2017-07-15").count() == 0


def test_old_and_millisecond_times(spark):
    df = spark.createDataFrame(
        [(1, "v", t, 1, 1, "s", "phone") for t in (1400000000, 1500000000, 1500000000000)], RELATION
    )
    assert clean_relations_since(df).count() == 2


@pytest.mark.parametrize("users,kept", [(1, 0), (2, 0), (3, 3), (19, 19), (100, 100), (101, 0)])
def test_group_size_limits(spark, users, kept):
    source = relations(spark, {5: range(users)})
    assert shared_members(source, ["node_id"], "user_id", 2, 100).count() == kept


def test_size_by_rows_or_users(spark):
    source = relations(spark, {5: [1, 2]}, repeat=2)
    assert shared_members(source, ["node_id"], "user_id", 2, 100).count() == 0
    by_rows = shared_members(source, ["node_id"], "user_id", 2, 100, count_rows=True)
    assert {(r["user_id"], r["members"]) for r in by_rows.collect()} == {(1, 2), (2, 2)}


def brute_force(values, flags, rounds=5):
    """The whole job in plain Python."""
    pairs = defaultdict(list)
    for node, users in values.items():
        users = sorted({u for u in users if u in flags})
        if 2 < len(users) <= 100:
            for pair in combinations(users, 2):
                pairs[pair].append(f"phone::v{node}")
    label = {u: u for pair in pairs for u in pair}
    for _ in range(rounds):
        votes = {u: Counter() for u in label}
        for a, b in pairs:
            votes[a][label[b]] += 1
            votes[b][label[a]] += 1
        label = {u: min(c, key=lambda x: (-c[x], x)) for u, c in votes.items()}
    carried = defaultdict(list)
    for (a, b), shared in pairs.items():
        carried[label[a]] += shared
        carried[label[b]] += shared
    result = {}
    for group in set(label.values()):
        marks = [1 if flags[u] == 3 else 0 for u, g in label.items() if g == group]
        result[group] = (sum(marks), len(marks), sorted(carried[group]))
    return result


def test_groups_match_brute_force(spark):
    values = {
        1: [1, 2, 3], 2: [3, 2, 1, 1], 3: [3, 4, 5], 4: [10, 11, 12, 13], 5: [12, 13, 14],
        6: [20, 21], 7: range(200, 320), 8: [1, 2, 99],
    }
    flags = {u: 1 + u % 3 for u in range(400) if u != 99}
    classify = spark.createDataFrame([(u, f, None, 0, 0, 0, 0, 0) for u, f in flags.items()], CLASSIFY)
    found = group_detection.detect_groups(relations(spark, values), classify, "phone").collect()
    got = defaultdict(list)
    for r in found:
        got[r["group_id"]] += [r["value"]] * r["times"]
    want = brute_force(values, flags)
    assert {g: sorted(v) for g, v in got.items()} == {g: v for g, (_, _, v) in want.items()}
    for r in found:
        good, total, _ = want[r["group_id"]]
        assert r["total"] == total
        assert r["good_rate"] == pytest.approx(int(100 * good / total + 0.5) / 100)
        assert r["rel"] == "phone"


def test_groups_append_to_partitioned_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS found_groups")
    groups = group_detection.detect_groups(relations(spark, {1: [1, 2, 3]}), classified(spark, range(5)), "phone")
    group_detection.write_groups(groups, "found_groups")
    group_detection.write_groups(groups, "found_groups")
    assert spark.table("found_groups").columns[-1] == "rel"
    assert spark.table("found_groups").count() == 2
    spark.sql("DROP TABLE found_groups")


def level(spark, users, unclassified=0, **share):
    """Rule level of one value; ``share`` says how many of the users have a mark."""
    names = ("last_order_nid", "if_last_order_success", "is_duotou", "is_high_risk_reject", "is_blacklist", "is_overdue")
    rows = [
        (u, 3, *[(1 if u < share.get(n, 0) else (None if n == "last_order_nid" else 0)) for n in names])
        for u in range(users)
    ]
    source = relations(spark, {1: range(users + unclassified)})
    found = single_property.group_relation(
        source, spark.createDataFrame(rows, CLASSIFY), "2024-01-01", at_least=2
    ).collect()
    return found[0]["group_level"]


@pytest.mark.parametrize(
    "case,want",
    [
        (dict(users=20, if_last_order_success=10, is_overdue=2, last_order_nid=20), "1"),
        (dict(users=20, if_last_order_success=10, is_overdue=1, last_order_nid=20), "0"),
        (dict(users=20, if_last_order_success=9, is_overdue=9, last_order_nid=20), "0"),
        (dict(users=20, last_order_nid=8, is_high_risk_reject=4), "2"),
        (dict(users=20, last_order_nid=8, is_high_risk_reject=3), "0"),
        (dict(users=20, last_order_nid=10, is_high_risk_reject=10), "0"),
        (dict(users=20, last_order_nid=0, is_high_risk_reject=20), "0"),
        (dict(users=20, last_order_nid=20, is_blacklist=6), "3"),
        (dict(users=20, last_order_nid=20, is_blacklist=5), "0"),
        (dict(users=20, unclassified=1, last_order_nid=20, is_blacklist=6), "0"),
        (dict(users=20, last_order_nid=20, is_duotou=16), "4"),
        (dict(users=20, last_order_nid=20, is_duotou=15), "0"),
        (dict(users=20, last_order_nid=9, is_high_risk_reject=9, is_blacklist=20, is_duotou=20), "2|3|4"),
    ],
)
def test_risk_rules(spark, case, want):
    assert level(spark, **case) == want


@pytest.mark.parametrize("users,rows", [(19, 0), (20, 1)])
def test_default_size_of_risk_groups(spark, users, rows):
    source = relations(spark, {1: range(users)})
    assert single_property.group_relation(source, classified(spark, range(users)), "2024-01-01").count() == rows


def test_tables_of_one_value(spark):
    source = relations(spark, {1: range(3), 2: range(2)})
    classify = spark.createDataFrame([(u, 3, 1, 0, 0, 0, 1, 0) for u in range(3)], CLASSIFY)
    groups = single_property.group_relation(source, classify, "2024-01-01", at_least=2)
    row = groups.where("match_value = 'v1'").first()
    assert row["match_user"] == "0,1,2"
    assert row["match_count"] == "3"
    assert row["group_trace"] == "{3,2024-01-01}"
    users = single_property.user_group(groups, "2024-01-01")
    first = users.where("user_id = '0'").collect()
    assert {(r["group_cnt"], r["bad_group_cnt"]) for r in first} == {(2, 2)}
    assert len({r["match_group_id"] for r in first}) == len(first) == 2
    assert users.where("user_id = '2'").first()["group_cnt"] == 1
    everything = single_property.all_relation(source, "2024-01-01")
    assert everything.count() == 5
    assert everything.first()["add_time"] == "2017-07-14 02:40:00"
