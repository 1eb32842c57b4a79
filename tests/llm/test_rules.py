"""Quality rules against counting by hand and against SQL."""

import re
from collections import Counter

from tabkit.llm import queries, rules
from tests.llm.frames import edge_docs, edge_rows, empty_docs, prose
from tests.oracle import connect, difference


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(triples)
    covered = {i + j for i, t in enumerate(triples) if times[t] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=str)


def test_counts_by_hand(spark):
    rows = edge_rows() + [(20, "a b c a b c d " * 9, "en", "a", 1), (21, "x\nx\n\nx y\nx", "en", "a", 1), (22, "#|<>&% a$*", "en", "a", 1),
                          (23, prose(9, 200) + "\n" + prose(9, 200), "en", "a", 1), (24, "w " * 3000, "en", "a", 1)]
    got = rules.quality_rules(edge_docs(spark, rows)).collect()
    assert base(got) == sorted(((r[0], *counted(r[1])) for r in rows), key=str)
    assert all(not (r.base_failed and r.kept) for r in got)


def test_frequent_lines_go_and_copies_do_not_count(spark):
    common = " ".join(f"Common{i}" for i in range(60))
    rows = [(i, prose(i + 100, 60) + "\n" + common, "en", "h", 0) for i in range(30)]
    rows += [(100, common.upper() + " \n" + prose(400, 20), "en", "h", 0)]  # little is left of it
    rows += [(200 + i, prose(500, 90), "en", "h", 0) for i in range(40)]  # copies of one text are one document
    rows += [(300, common, "en", "other", 0)]  # another host
    got = {r.doc_id: r for r in rules.quality_rules(edge_docs(spark, rows)).collect()}
    assert got[0].removed_words == 60 and not got[0].kept and got[0].cleaned_text == prose(100, 60)
    assert got[100].removed_words == 60 and not got[100].kept
    assert all(got[200 + i].kept and got[200 + i].removed_words == 0 for i in range(40))
    assert got[300].kept


def test_empty_table(spark):
    assert rules.quality_rules(empty_docs(spark)).collect() == []


def test_same_as_sql(spark, small):
    assert difference(queries.op1_quality_rules(spark, small), connect(small), queries.SQL["op1_quality_rules"]) is None


def test_no_python(spark, small):
    plan = queries.op1_quality_rules(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow|Cartesian|NestedLoop", plan)
