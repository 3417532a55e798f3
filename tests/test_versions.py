"""The nearest version against a walk over all tags."""

import random
import re

from pyspark.sql import functions as F

from shelfspark.operators import joins

WHOLE = re.compile(r"[vV]?(\d+)\.(\d+)(?:\.(\d+))?(?:[-+](.*))?")


def semver(text):
    m = WHOLE.fullmatch(text)
    return m and (int(m[1]), int(m[2]), int(m[3] or 0), m[4] or "")


def order(v):
    return (*v[:3], v[3] == "", v[3])


def walk(version, tags):
    tags = [t.strip() for t in tags if re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z._/+-]*", t.strip())]
    name = version.strip()
    if not name:
        return None
    for same in (lambda t: t == name, lambda t: re.sub("^[vV]", "", t) == re.sub("^[vV]", "", name)):
        if found := [t for t in tags if same(t)]:
            return found[0]
    target = semver(name)
    best = None
    for t in tags if target else ():
        v = semver(t) or semver(re.sub(r"^[^0-9]*[-_/][vV]?(?=[0-9])", "", t))
        if v and v[0] == target[0]:
            far = abs(v[1] - target[1]) * 1000 + abs(v[2] - target[2]) + (v[3] != target[3])
            newer = order(v) > order(target)
            # Older before newer; among older the newest, among newer the oldest; then the first.
            value = (far, newer, tuple((x if newer else -x) for x in v[:3]), order(v)[3:], t)
            if best is None or (far, newer) < best[0][:2] or ((far, newer) == best[0][:2] and (order(v) < best[1] if newer else order(v) > best[1])):
                best = (value, order(v))
    return best and best[0][-1]


def test_nearest_tags_against_a_walk(spark):
    rnd = random.Random(11)
    pick = lambda: f"{rnd.randint(0, 2)}.{rnd.choice([0, 1, 2, 3, 9])}.{rnd.choice([0, 1, 2, 5, 999, 1000, 2500])}" + rnd.choice(["", "", "", "-rc1", "-rc2", "-beta", "+7"])
    wanted, tags, want = [], [], []
    for repo in range(120):
        mine = [rnd.choice(["", "v", "V", "stable-", "app-v", "release/", "build", " "]) + pick() for _ in range(rnd.choice([0, 1, 3, 12, 60]))] + rnd.sample(["nightly", "main", "bad tag", "", "1.2"], 2)
        rnd.shuffle(mine)
        tags += [(repo, k, t) for k, t in enumerate(mine)]
        for version in {pick() for _ in range(4)} | {rnd.choice(["nightly", "v1.2", "", " 1.0.0 ", "7"])}:
            wanted.append((repo, version))
            want.append((repo, version, walk(version, mine)))
    got = joins.closest_version(spark.createDataFrame(wanted, "repo int, version string"), spark.createDataFrame(tags, "repo int, pos int, tag string"), "repo").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_equal_tags_go_to_the_first_and_nothing_meets_nothing(spark):
    tags = spark.createDataFrame([(1, 0, "v1.2.0"), (1, 1, "app-1.2.0"), (2, 0, "1.0.0")], "repo int, pos int, tag string")
    wanted = spark.createDataFrame([(1, "1.2.1"), (1, "1.2.1"), (2, "2.0.0"), (3, "1.0.0"), (None, "1.0.0"), (2, None)], "repo int, version string")
    got = joins.closest_version(wanted, tags, "repo").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "1.2.1", "v1.2.0"), (1, "1.2.1", "v1.2.0"), (2, "2.0.0", None), (3, "1.0.0", None), (None, "1.0.0", None), (2, None, None)]))
    assert joins.closest_version(wanted, tags.limit(0), "repo").filter("tag IS NOT NULL").count() == 0


def test_written_cases(spark):
    cases = [("6.6.4", "v6.6.3 v6.6.4 v6.6.5", "v6.6.4"), ("6.6.4", "6.6.4 v6.6.4", "6.6.4"), ("6.6.4", "v6.6.3 v6.6.5", "v6.6.3"), ("1.11.0", "1.10.0 1.11.2", "1.11.2"), ("1.11.0", "nightly", None), ("nightly", "nightly v1.0.0", "nightly"), ("35.0.1", "1.0.0 stable-35.0.0 stable-35.0.1 stable-34.1.1", "stable-35.0.1"), ("35.0.1", "1.0.0 v2.3.0", None), ("1.2.0", "app-v1.2.0 app-v1.1.0", "app-v1.2.0"), ("1.2.0", "build42", None)]
    tags = spark.createDataFrame([(k, n, t) for k, (_, ts, _) in enumerate(cases) for n, t in enumerate(ts.split())], "repo int, pos int, tag string")
    wanted = spark.createDataFrame([(k, v) for k, (v, _, _) in enumerate(cases)], "repo int, version string")
    assert {r.repo: r.tag for r in joins.closest_version(wanted, tags, "repo").collect()} == {k: want for k, (_, _, want) in enumerate(cases)}


def test_only_tags_of_asked_majors_go_on(spark, monkeypatch):
    made = {}
    whole = joins.cut
    monkeypatch.setattr(joins, "cut", lambda df, name="cut": made.setdefault(name, whole(df, name)))
    tags = spark.createDataFrame([(k, n, t) for k in (1, 2) for n, t in enumerate(["v1.0.0", "2.0.1", "app-2.1.0", "3.0.0", "nightly", "vv2.0"])], "repo int, pos int, tag string")
    wanted = spark.createDataFrame([(1, "2.0.0"), (1, "2.0.1"), (1, "nightly"), (2, "vv2.0"), (2, "1.0.0")], "repo int, version string")
    got = {(r.repo, r.version): r.tag for r in joins.closest_version(wanted, tags, "repo").collect()}
    assert got == {(1, "2.0.0"): "2.0.1", (1, "2.0.1"): "2.0.1", (1, "nightly"): "nightly", (2, "vv2.0"): "vv2.0", (2, "1.0.0"): "v1.0.0"}
    assert sorted((r.k, r.tag) for r in made["versions"].collect()) == [(1, "2.0.1"), (1, "app-2.1.0"), (2, "v1.0.0")]
    plan = made["asked"]._jdf.queryExecution().optimizedPlan().toString()
    assert "rlike" not in plan.lower()
    parsed = spark.createDataFrame([("v1.2",)], "x string").select(joins.semver(F.col("x")).alias("v"))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("regexp_") == 1
