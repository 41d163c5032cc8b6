import random

import pytest

from surveil.llm import url_filter


@pytest.mark.parametrize("most", [1000, 40])
def test_the_mix_of_the_verdicts_does_not_depend_on_the_sample(spark, most):
    rnd = random.Random(1)
    name = lambda: f"{rnd.getrandbits(40):x}.net"
    rows = [(name(), "/", url_filter.ALLOW if i % 4 else url_filter.BLOCK) for i in range(400)]
    labelled = spark.createDataFrame(rows, "host string, path string, verdict string")
    sample = url_filter.labelled_sample(labelled, most).collect()
    weight = lambda v: sum(r["weight"] for r in sample if r["verdict"] == v)
    assert (weight(url_filter.ALLOW), weight(url_filter.BLOCK)) == pytest.approx((300, 100))
    fresh = spark.createDataFrame([(f"http://{name()}/",) for _ in range(200)], "url string")
    scores = [r["block_score"] for r in url_filter.judge(fresh, [], labelled=labelled, max_labelled=most).collect()]
    assert sum(scores) / len(scores) < 0.38


def fitting(host, path, rules):
    """The rule that fits, by trying all."""
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.name), r.name, r.verdict), default=None)
    return best and (best.name, best.verdict)


@pytest.mark.parametrize("seed", [1, 2])
def test_joined_rules_are_those_of_the_expression_and_of_trying_all(spark, seed):
    rnd = random.Random(seed)
    word = lambda a, n: "".join(rnd.choice(a) for _ in range(rnd.randint(0, n)))
    rules = [url_filter.Rule(rnd.choice(["allow", "block"]), word("ab.", 4), rnd.choice(["", "/"]) + word("xé/", 3)) for _ in range(60)]
    urls = [("", ""), (".", "/"), ("a", "")] + [(word("abc.", 7), rnd.choice(["", "/"]) + word("xé/日", 6)) for _ in range(400)]
    urls += [urls[-1]] * 200  # one URL holds a third of the rows
    frame = spark.createDataFrame([(*u, i) for i, u in enumerate(urls)], "host string, path string, n long")
    rows = [(r.verdict, r.host, r.path) for r in rules]
    table = spark.createDataFrame(rows + rows + [(None, "a", "/"), ("allow", None, "/"), ("allow", "a", None)], "verdict string, host string, path string")
    want = [fitting(*u, rules) for u in urls]
    inline = frame.withColumn("__rule", url_filter.matching_rule(frame["host"], frame["path"], rules[:40]))
    assert [r["__rule"] and tuple(r["__rule"]) for r in inline.orderBy("n").collect()] == [fitting(*u, rules[:40]) for u in urls]
    for given in (rules, table):
        got = url_filter.with_rules(frame, given).orderBy("n").collect()
        assert [r["__rule"] and tuple(r["__rule"]) for r in got] == want
    assert len(set(want)) > 20


def test_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).selectExpr("if(id % 2 = 0, 'allow', 'block') AS verdict", "concat('h', id % 50, '.net') AS host", "concat('/', id) AS path")
    pages = spark.createDataFrame([(1, "http://www.h7.net/1057/a"), (2, "http://h7.net/1058"), (3, "http://h7.net/105799"), (4, None)], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got[1] == ("h7.net/1057", "block") and got[4][0] is None
    # of h7.net there are rules 7, 57, 107, ...: /1058 holds none, and /105799 starts with 1057 (10507 and 105757 do not fit)
    assert got[2][0] is None and got[3] == ("h7.net/1057", "block")
    assert url_filter.judge(pages.filter("1 = 0"), rules).count() == 0
    assert url_filter.judge(pages, rules.filter("1 = 0")).filter("rule IS NOT NULL").count() == 0
