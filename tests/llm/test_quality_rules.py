from __future__ import annotations

from reviewflow.llm import quality_rules as op

PROSE = " ".join(f"word{i} and some{i} more" + ("." if i % 5 else ".\n") for i in range(40))


def judged(spark, texts):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, kept INT")
    return {row.doc_id: row for row in op.judge_documents(docs).collect()}


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)})


def test_counts(spark):
    texts = [None, "", " \n\t", "a b c a b c", "é#é $x\nsame\nsame\n \n \n", "a a a a", "x" * 300_000, PROSE, "a b c\x0bd"]
    got = judged(spark, texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        lines = [line for line in (text or "").split("\n") if line.encode().split()]
        row = got[i]
        assert row.n_words == len(words)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == brute_repeats(words)
        assert row.base_failed == (len(words) < 50 or 2 * row.n_repeat_words > len(words))
    assert got[7].kept and got[7].rejected_by is None
    assert got[0].rejected_by == "base" and not got[0].kept


def test_rules_reject_what_they_name():
    words = [f"w{i}" for i in range(60)]
    for rule, text in {
        op.odd_word_length: "a " * 60,
        op.many_symbols: " ".join(w + "#" for w in words),
        op.many_duplicate_lines: "same line\n" * 60,
        op.bullet_list: "\n".join("- " + w for w in words),
        op.many_ellipses: "\n".join(w + "..." for w in words),
        op.few_letters: " ".join(map(str, range(60))),
        op.runs_of_a_word: " ".join(w for w in words for _ in range(2)),
        op.one_word_dominates: " ".join(w + " the" for w in words),
    }.items():
        assert rule(op.Document(text.encode())), rule
        assert not rule(op.Document(PROSE.encode())), rule


def test_order_changes_no_verdict(spark):
    docs = [op.Document(t.encode()) for t in (PROSE, "a " * 60, "same line\n" * 60)]
    one = [any(rule(d) for rule in op.RULES) for d in docs]
    assert one == [any(rule(d) for rule in reversed(op.RULES)) for d in docs] == [False, True, True]
    measured = {op.RULES[0].__name__: (1.0, 0.1), op.RULES[1].__name__: (0.1, 0.1), op.RULES[2].__name__: (0.1, 0.5)}
    assert op.ordered(op.RULES[:3], measured) == (op.RULES[2], op.RULES[1], op.RULES[0])
    assert op.ordered(op.RULES, {}) == op.RULES


def test_measured_on_documents_that_pass_the_base_test(spark):
    """Rejections are shares of the documents that a rule is asked about, and those of the whole table are drawn from."""
    long = " ".join(f"w{i}" for i in range(60))
    numbers = " ".join(str(i) for i in range(60))
    docs = spark.createDataFrame([(i, (long, numbers, "short", None)[i % 4]) for i in range(400)], "doc_id BIGINT, text STRING")
    measured = op.measure(docs.orderBy("text"), op.RULES, 1000)
    assert set(measured) == {rule.__name__ for rule in op.RULES}
    assert all(seconds > 0 for seconds, _ in measured.values())
    assert measured["few_letters"][1] == 0.5 and measured["bullet_list"][1] == 0
    # A sample of a sorted table holds both kinds.
    assert 0.2 < op.measure(docs.orderBy("text"), op.RULES, 200)["few_letters"][1] < 0.8


def test_two_orders_give_the_same_verdicts(spark, tables, monkeypatch):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    verdicts = []
    for rules in (op.RULES, op.RULES[::-1]):
        monkeypatch.setattr(op, "ordered", lambda _, __, rules=rules: rules)
        verdicts.append(sorted(map(tuple, op.judge_documents(docs).drop("rejected_by").collect())))
    assert verdicts[0] == verdicts[1]


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id BIGINT, text STRING")
    assert op.judge_documents(docs.limit(0)).count() == 0
    assert op.judge_documents(docs).count() == 3


def test_good_documents_of_the_tables_are_kept(spark, tables):
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    rows = op.judge_documents(spark.read.parquet(f"{tables}/documents.parquet")).join(labels, "doc_id")
    good = rows.where("quality = 1 AND NOT base_failed")
    assert good.count() > 20
    assert good.where("NOT kept").count() == 0
