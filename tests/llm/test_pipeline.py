import re

import corpus_pipeline
from tablesync.llm import mixing
from tablesync.llm.packing import default_tokenizer
from tablesync.llm.parity_join import Likeness
from test_mixing import fill
from test_parity_join import by_hand
from test_pii import PLAIN, plain
from test_quality_rules import base


def test_stages_follow_each_other(spark, documents, prose, tmp_path):
    """Each stage against a plain account of it, on its own input; the last against the pieces' sums."""
    common = "the of and to in a is that it for was on as with be by this are at from"
    rows = []
    for i in range(60):
        text = f"{prose(i % 40, 150)} {common} {prose(i % 40 + 300, 100)}"
        rows.append((i, text + (f" tail{i}" if i >= 40 else "") + (" me@host.example" if i % 9 == 0 else ""), ["en", "fr"][i % 2], f"src{i % 7}"))
    rows += [(70, "too short", "en", "src1"), (71, None, None, None), (72, " ".join(f"{w}%%%###" for w in rows[0][1].split()), "en", "src2")]
    folder = str(tmp_path / "sf")
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "mixing", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name == "quality_rules":
            assert {r.doc_id for r in after} == set(range(60)) and all(not base(r.text)[5] for r in after)
        if name == "near_duplicates":
            hand = by_hand([(i, r.text) for i, r in before.items()], Likeness(5, 80))
            assert sorted(r.doc_id for r in after) == sorted({c for _, c in hand.values()}) and len(after) == 40
        if name == "personal_data":
            for r in after:
                text = before[r.doc_id].text
                for _, a, b in reversed(plain(text)):
                    text = f"{text[:a]}[EMAIL]{text[b:]}"
                assert r.text == text and not any(p.search(r.text) for p in PLAIN[:1])
        if name == "mixing":
            tokens = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in before.items()}
            domain = lambda r: "web" if int(r.source[3:]) < 5 else "books"
            caps = {d: 2 * sum(tokens[i] for i, r in before.items() if domain(r) == d) for d in ("web", "books")}
            wanted = fill({"web": (40, caps["web"]), "books": (25, caps["books"])}, sum(tokens.values()))
            for d, budget in wanted.items():
                used = sum(tokens[r.doc_id] for r in after if domain(r) == d)
                assert used <= budget and used > budget - 10 * max(tokens.values())
            mixed_texts = sorted(r.text for r in after)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    assert sum(r.length for r in after) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in mixed_texts)
    assert len({r.sequence_id for r in after}) <= sum(r.length for r in after) // 4096 + 2
    same = corpus_pipeline.run(spark, folder)
    assert sorted(tuple(r)[:5] for r in same.collect()) == sorted(tuple(r)[:5] for r in after)
    assert mixing.PRODUCTION.max_epochs == 2
