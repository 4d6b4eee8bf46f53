"""URL filters, Merkle manifest and prefix trie against plain versions, and their odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake.llm import list_rank, merkle, prefix_trie, queries, url_rules
from tests.oracle import difference


@pytest.mark.parametrize("name", ["op11_url_verdicts", "op12_manifest", "op13_prefix_trie"])
def test_query_equals_its_sql(spark, sf_small, name):
    assert difference(spark, sf_small, queries.QUERIES[name], queries.ORACLES[name]) is None


# ======== 11 ========


def judged(spark, rows, redirects=None, rules=queries.URL_RULES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("node", "host", "path", "rule", "fit", "root")})
    found = url_rules.judged(df, url_rules.rule_table(spark, rules), redirects)
    return {r["page_id"]: (r["rule"], r["verdict"], r["reason"]) for r in found.collect()}


def test_blocks_pass_to_aliases_and_rules_of_their_own_win(spark):
    rows = [
        (1, "http://www.x.com/a/", "<link rel='stylesheet' href='q'><link href=\"//y.com/de/9\" rel=canonical>"), (2, "https://x.com/a?utm_source=1", None),
        (3, "https://z.net/", "<META content='0; URL=http://x.com/a#p' http-equiv=Refresh>"), (4, "http://x.com/fr/1", "<link rel=canonical href=../de/>"),
        (7, "http://q.net/b", "<!-- <link rel=canonical href=http://x.com/a> --><script>'<link rel=canonical href=http://x.com/a>'</script>"),
        (8, "https://z.net/index.html#q", "x"), (9, "HTTP://A.EXAMPLE.Org/en/12?x#y", None), (10, "http://log.net/1", None), (11, "https://free.net", None),
    ]
    redirects = spark.createDataFrame([("http://log.net/1", "http://b.log.net"), ("http://b.log.net", "http://c.com/de/"), (None, "http://x.com/a")], "source string, target string")
    alias, free = (None, "block", "alias"), (None, "allow", "default")
    assert judged(spark, rows, redirects) == {
        1: alias, 2: alias, 3: alias, 4: ("com/fr/", "allow", "rule"), 7: free, 8: alias, 9: ("example.org/en/1", "block", "rule"), 10: alias, 11: free,
    }


def test_a_canonical_hub_and_a_chain_of_redirects(spark):
    rows = [(i, f"http://h{i}.net/", "<link rel=canonical href='http://hub.net/'>") for i in range(60)] + [(100, "http://c0.net", "")]
    chain = spark.createDataFrame([(f"http://c{i}.net", f"http://c{i + 1}.net") for i in range(30)] + [("http://c30.net", "http://hub.net"), ("http://hub.net/", "http://bad.com/de/x")], "source string, target string")
    assert set(judged(spark, rows, chain).values()) == {(None, "block", "alias")}


def test_longest_rule_wins_and_odd_urls(spark):
    rules = [url_rules.Rule("block", "a.com", "/x"), url_rules.Rule("allow", "b.a.com", "/"), url_rules.Rule("allow", "com", "/x/y/"), url_rules.Rule("block", "a.com", "/x/y/z")]
    rows = [
        (1, "http://A.com/x", None), (2, "http://b.a.com/x/y/zz", None), (3, "http://b.a.com/q", None), (4, "http://ba.com/x/y/", None), (5, "http://xa.com/x", None),
        (6, None, None), (7, "no url", ""), (8, "http://", ""), (9, "http://a.com?x", None), (10, "x://" + "l." * 500 + "a.com/x", None), (None, "http://a.com/x", None),
    ]
    rule = lambda r, v: (r, v, "rule")
    free = (None, "allow", "default")
    assert judged(spark, rows, rules=rules) == {
        1: rule("a.com/x", "block"), 2: rule("a.com/x/y/z", "block"), 3: rule("b.a.com/", "allow"), 4: rule("com/x/y/", "allow"), 5: free, 6: free, 7: free, 8: free, 9: free,
        10: rule("a.com/x", "block"), None: rule("a.com/x", "block"),
    }
    assert judged(spark, rows[:2], rules=[]) == {1: free, 2: free} and judged(spark, [(1, "http://a.com/x", "")] * 3, rules=rules) == {1: rule("a.com/x", "block")}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_rules.judged(empty, url_rules.rule_table(spark, rules)).count() == 0
    with pytest.raises(ValueError):
        url_rules.Rule("maybe", "a.com", "/")


# ======== 12 ========


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, fan):
    """{row: (leaf, subroot, root, proof, folded root)} of rows (id, group, text, text now)."""
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(code(r[0]), code(r[1]), code(text))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
        return out

    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[2]))):
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r, r[2]) for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            own, siblings = leaf(r, r[3]), []
            for at, tree in ((i, trees[g]), (k, top)):
                for nodes in tree[:-1]:
                    first = at - at % fan
                    left, right = nodes[first:at], nodes[at + 1 : first + fan]
                    siblings += left + right
                    own = sha(*left, own, *right)
                    at //= fan
            out.append((r[0], leaf(r, r[2]), trees[g][-1][0], top[-1][0], sha(*siblings), own, own == top[-1][0]))
    return out


@pytest.mark.parametrize("fan, every", [(8, 3), (2, 2), (3, 1)])
def test_manifest_of_groups_of_all_sizes(spark, fan, every):
    sizes = {None: 1, "": 2, "a": 9, "A": 8, "é": 65, "z": 140}
    rows = [(i if i % 11 else None, g, None if i % 7 == 0 else f"Text {i} é", None if i % 7 == 0 else f"{'text' if i % 3 == 0 else 'Text'} {i} é") for g, n in sizes.items() for i in range(n)]
    rows += [(5, "z", "Twice", "Twice")] * 3
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, now string").repartition(5)
    df = df.withColumns({c: F.lit("x") for c in ("id", "tree", "pos", "n", "digest", "shown", "place", "root")})
    shown = merkle.digest_of([F.col("doc_id"), F.col("lang"), F.col("now")])
    found = merkle.verified(df, ("doc_id", "lang", "text"), shown=F.when(F.col("text") != F.col("now"), shown), fan=fan, every=every).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_manifest(rows, fan), key=str)


def test_manifest_of_nothing_and_of_one_row(spark):
    one = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    (row,) = merkle.verified(one, ("doc_id", "lang", "text")).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == sha("1:1--") and row["verified"] and row["proof_sha256"] == sha()
    assert merkle.verified(one.where("false"), ("doc_id", "lang", "text")).count() == 0


# ======== 13 ========


def plain_trie(rows, group=100, most=6):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(math.fmod(c, group))  # as in SQL
        whole = tuple(turns.get(base, [])[:h] + turns[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in children
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
    return sorted(
        (m[0], len(s), members[s[:-1]][0] if s else -1, len(m), children[s], leaves[s], saved[s], hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest())
        for s, m in members.items()
    )


def trie_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("conv", "i", "j", "r", "hi", "digest", "chars", "depth", "place", "id", "size")})
    found = prefix_trie.prefix_trie(df, **options).collect()
    steps = sorted(x for r in found for x in (r["enter"], r["leave"]))
    assert steps == list(range(2 * len(found)))
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:8]) for r in map(tuple, found))


@pytest.mark.parametrize("block", [2, 6, 1 << 17])
def test_trie_of_odd_conversations(spark, block, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rng = random.Random(block)
    said = ["a", "b", "", None, "ç 😀", "long " * 30]
    rows = [(c, t, rng.choice(["user", "assistant", None]) if t else "user", rng.choice(said[:2] if t < 2 else said)) for c in [*range(0, 90), *range(300, 320), 777] for t in range(rng.randint(1, 8))]
    rows += [(5000, t, "user", f"turn {t}") for t in range(40)] + [(5001, t, "user", f"turn {t}") for t in range(40)]
    rows += [(6000, None, "user", "first"), (6000, 1, None, "tie"), (6000, 1, "user", "tie"), (6000, 1, "user", "tie"), (None, 1, "user", "nobody's"), (-7, 0, "user", "below zero")]
    assert trie_of(spark, rows, block=block) == plain_trie(rows)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    rows = [(c, 0, "user", "only") for c in range(101, 130)]
    expected = plain_trie(rows)
    assert trie_of(spark, rows) == expected and expected[0][4] < 30
    assert trie_of(spark, []) == []


@pytest.mark.parametrize("kind", ["shuffled", "sorted", "backwards", "several"])
def test_list_ranking_of_any_list(spark, kind):
    n = 500
    order = list(range(n))
    if kind in ("shuffled", "several"):
        random.Random(1).shuffle(order)
    if kind == "backwards":
        order.reverse()
    lists = [order[i : i + 125] for i in range(0, n, 125)] if kind == "several" else [order]
    rows, expected = [], {}
    for one in lists:
        total = 0
        for item, follower in zip(one, [*one[1:], None]):
            rows.append((item, follower, item % 5))
            expected[item] = total
            total += item % 5
    items = spark.createDataFrame(rows, "id long, next long, w long")
    found = {r["id"]: r["b_w"] for r in list_rank.prefix_sums(items, ["w"], block=16).collect()}
    assert found == expected
    assert list_rank.prefix_sums(items.where("false"), ["w"]).count() == 0


def test_chains_within_a_block():
    ids, nexts = np.array([3, 4, 7, 9]), np.array([9, 99, -1, 4])
    head, tail, sums = list_rank.chains(ids, nexts, np.array([[1, 2, 4, 8]]))
    assert head.tolist() == [3, 3, 7, 3] and tail.tolist() == [False, True, True, False] and sums.tolist() == [[0, 9, 0, 1]]
