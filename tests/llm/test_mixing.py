import pytest

from tablesync.llm.mixing import Level, Mixture, leaf_budgets, mixed, mixed_ids


def tree(**more):
    return Mixture([Level("domain", "label", {"a": 3, "b": 1}, 1), Level("lang", "lang"), Level("source", "source", {"s0": 2, "off": 0}, 1)], **more)


def fill(nodes, budget):
    """Shares of {name: (weight, cap)} by raising one level until the budget is used."""
    open_, left, out = dict(nodes), budget, {}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, c) in open_.items() if total == 0 or c * total <= w * left]
        if not full:
            return out | {k: w * left // total for k, (w, _) in open_.items()}
        for k in full:
            out[k] = open_[k][1]
        left -= sum(open_.pop(k)[1] for k in full)
    return out


def budgets_by_hand(leaves, mixture):
    wd, ws = {"a": 3, "b": 1}, {"s0": 2, "off": 0}
    cap = {k: 0 if ws.get(k[2], 1) == 0 else t * mixture.max_epochs for k, t in leaves.items()}
    wanted = sum(leaves.values()) if mixture.total_tokens is None else mixture.total_tokens
    found = {}
    domains = fill({d: (wd.get(d, 1), sum(c for k, c in cap.items() if k[0] == d)) for d in {k[0] for k in cap}}, min(wanted, sum(cap.values())))
    for d, budget in domains.items():
        langs = fill({x: (1, sum(c for k, c in cap.items() if k[:2] == (d, x))) for x in {k[1] for k in cap if k[0] == d}}, budget)
        for x, share in langs.items():
            own = fill({k[2]: (ws.get(k[2], 1), c) for k, c in cap.items() if k[:2] == (d, x)}, share)
            found |= {(d, x, s): b for s, b in own.items()}
    return found


@pytest.mark.parametrize("total", [None, 0, 7, 500, 100_000])
def test_shortages_go_to_siblings_before_ancestors(spark, total):
    leaves = {("a", "en", "s0"): 100, ("a", "en", "s1"): 3, ("a", "fr", "s0"): 10, ("b", "en", "s0"): 400, ("b", "en", "off"): 50, ("c", "", "s2"): 1}
    mixture = tree(total_tokens=total)
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    got = {tuple(r)[:3]: r.budget for r in leaf_budgets(frame, mixture).collect()}
    assert got == budgets_by_hand(leaves, mixture)
    assert sum(got.values()) <= min(sum(leaves.values()) if total is None else total, sum(leaves.values()) * 2)


def test_prefixes_epochs_and_columns(documents, prose):
    rows = [(i, prose(i, 5 + i % 30), "en", f"s{i % 3}") for i in range(300)] + [(900, None, None, None), (901, "", "fr", "off"), (902, "gone with it", "fr", "off")]
    docs = documents(rows)
    for bucket in (7, 1000):  # many hash buckets, or one: the same choice
        got = mixed_ids(docs, Mixture([Level("source", "source", {"s0": 6, "s1": 1, "s2": 1}, 0)], total_tokens=2000, bucket_rows=bucket)).collect()
        tokens = {}
        for r in got:
            tokens[r.source] = tokens.get(r.source, 0) + r.tokens
        longest = 34
        assert tokens["s1"] <= 250 and tokens["s1"] > 250 - longest and tokens["s0"] > 1500 - longest
        assert len({(r.doc_id, r.epoch) for r in got}) == len(got) and {r.epoch for r in got} <= {1, 2}
        chosen = sorted((r.doc_id, r.epoch) for r in got)
        assert bucket == 7 or chosen == before
        before = chosen
    twice = mixed(docs, Mixture([Level("source", "source")], total_tokens=10**9))
    assert twice.columns == docs.columns
    counted = {r.doc_id: r["count"] for r in twice.groupBy("doc_id").count().collect()}
    assert counted[5] == 2 and 900 not in counted  # a leaf without tokens gives nothing
    once = mixed_ids(docs, Mixture([Level("source", "source")], total_tokens=10**9, max_epochs=1))
    assert {r.epoch for r in once.collect()} == {1}


def test_same_ids_share_their_fate_and_empty_table(documents, prose):
    docs = documents([(i // 4, prose(i // 4, 9), "en", "s") for i in range(80)])
    got = mixed_ids(docs, Mixture([Level("source", "source")], total_tokens=300)).groupBy("doc_id").count().collect()
    assert got and all(r["count"] == 4 for r in got)
    assert mixed_ids(docs.where("false"), Mixture([Level("source", "source")])).count() == 0
