import pytest
import re

from helpers import docs, odd_rows, prose

from gaugeloom.llm import line_dedup


def brute_force(rows):
    """Kept texts by (identifier, text); rows equal in both are one document."""
    seen, kept = set(), {}
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        lines = []
        for line in text.split("\n"):
            normal = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
            if len(normal.split(" ")) >= 5:
                if normal in seen:
                    continue
                seen.add(normal)
            lines.append(line)
        kept[doc_id, text] = "\n".join(lines)
    return kept


def test_against_brute_force(spark):
    shared = [prose(i, 8) for i in range(6)]
    rows = [(i, "\n".join([prose(50 + i, 9), shared[i % 6].upper(), "short one", shared[(i * 5) % 6], prose(90, 12)])) for i in range(40)]
    rows += [r for r in odd_rows() if r != (5, prose(6, 50))] + [(200, ""), (201, None)]
    df = line_dedup.without_repeated_lines(docs(spark, rows))
    want, found = brute_force(rows), df.collect()
    assert len(found) == len(rows)
    for r in found:
        text = r.text or ""
        assert r._kept == want[r.doc_id, text]
        removed = [text[x.s : x.e] for x in r._removed]
        assert len(text) - len(r._kept) in (sum(len(x) + 1 for x in removed), sum(len(x) + 1 for x in removed) - 1)


def test_empty(spark):
    df = docs(spark, [(1, "x")]).where("false")
    assert line_dedup.without_repeated_lines(df).columns[:-2] == df.columns
    assert line_dedup.without_repeated_lines(df).count() == 0


def test_many_repeated_lines(spark):
    """One text of very many equal lines among others: the work grows with the lines, not with their square."""
    line = "five words are in here"
    text = "\n".join([line] * 40_000 + ["another line of five words", ""] + [line] * 40_000)
    rows = line_dedup.without_repeated_lines(docs(spark, [(1, text), (2, line), (3, "short\n" + line + "\nlast")])).collect()
    kept = {r.doc_id: (len(r["_removed"]), r["_kept"]) for r in rows}
    assert kept == {1: (79_999, line + "\nanother line of five words\n"), 2: (1, ""), 3: (1, "short\nlast")}


def test_output_columns_that_exist(spark):
    table = docs(spark, [(1, "x")])
    for name in ("_removed", "_Kept"):
        with pytest.raises(ValueError):
            line_dedup.without_repeated_lines(table.withColumnRenamed("line", name))
    taken = table.withColumnsRenamed({"line": "_gone", "node": "no"})
    assert line_dedup.without_repeated_lines(taken).columns == [*taken.columns, "_removed", "_kept"]
