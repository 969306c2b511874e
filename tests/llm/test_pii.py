import hashlib
import random
import re

import pytest
from helpers import docs, odd_rows, prose

from gaugeloom.llm import pii
from gaugeloom.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def tricky():
    r = random.Random(4)
    pieces = ["a@b.c", "x.y+z@host-1.example.com", "@", ".", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.2.3.0004"]
    pieces += ["4539 1488 0343 6467", "4539-1488-0343-6467", "4539148803436467", "0000 0000 0000 0000", "123", "- 4"]
    pieces += ["+1 (269) 555-3296", "+49.89.1234-5678", "+1", "+(12345678", "12 34", "_", "%", " ", "  ", "\n", "é", "🙂", "-", " ", "\r"]
    return ["".join(r.choice(pieces) for _ in range(r.randint(1, 12))) for _ in range(1_500)]


def found(spark, rows):
    df = pii.of_documents(pii.findings(docs(spark, rows)))
    return df.select("doc_id", "mark", pii.described(df.spans, 4).alias("base"), pii.described(df.spans, 5).alias("all")).collect()


def test_base_findings_against_plain_patterns(spark):
    rows = list(enumerate(tricky()))
    got = {r.doc_id: r.base for r in found(spark, rows)}
    for doc_id, text in rows:
        assert got.get(doc_id, "") == ",".join(base(text)), text


@pytest.mark.parametrize("piece", ["a", "1.", "a@", "4 4-", "a@b.c ", "a@b.c\n"])
def test_long_texts(spark, piece):
    text = piece * 4_000
    rows = found(spark, [(1, text)])
    assert (rows[0].base if rows else "") == ",".join(base(text))


def test_disclosing_terms(spark):
    people = [f"please call kontakt agent {prose(i, 1)} at +1 (555) 555-{1000 + i} today" for i in range(12)]
    rows = [(i, prose(i, 30) + "\n" + line + "\n" + prose(500 + i, 30)) for i, line in enumerate(people)]
    rows += [(100 + i, f"please read this {prose(i, 20)} today at home") for i in range(200)]
    out = {r.doc_id: r for r in pii.sanitised(docs(spark, rows)).collect()}
    assert "<PHONE>" in out[3].text and "<TERM> <TERM>" in out[3].text  # kontakt, agent
    assert "please call" in out[3].text or "please <TERM>" in out[3].text
    assert "today" in out[3].text and "at <PHONE>" in out[3].text
    for i in range(200):
        assert out[100 + i].text == rows[12 + i][1]
    spans = {r.doc_id: r for r in found(spark, rows)}
    text = rows[3][1]
    terms = [s.split(":") for s in spans[3].all.split(",") if s.startswith("term")]
    assert {text[int(a) : int(b)] for _, a, b in terms} >= {"kontakt", "agent"}
    assert set(spans) == set(range(12))


def test_disclosing_terms_without_an_entity(spark):
    people = [f"please call kontakt {prose(i, 1)} at +1 (555) 555-{1000 + i} today" for i in range(12)]
    rows = [(i, prose(i, 30) + "\n" + line + "\n" + prose(500 + i, 30)) for i, line in enumerate(people)]
    rows[3] = (3, "Kontakt before\n\n" + people[3] + "\na kontakt after")
    rows += [(100 + i, f"please read this {prose(i, 20)} today at home") for i in range(200)]
    rows += [(400, "no\nnumber, kontakt: kontakt."), (400, "no\nnumber, kontakt: kontakt."), (None, "kontakt")]
    out = [(r.doc_id, r.text) for r in pii.sanitised(docs(spark, rows)).collect()]
    texts = dict(out)
    assert texts[3].startswith("<TERM> before\n\nplease <TERM> <TERM> ") and texts[3].endswith(" today\na <TERM> after")
    assert out.count((400, "no\nnumber, <TERM>: <TERM>.")) == 2 and texts[None] == "<TERM>"
    spans = {r.doc_id: r.all for r in found(spark, rows)}
    assert spans[400] == "term:11:18,term:20:27" and spans[None] == "term:0:7"


def test_odd_rows(spark):
    rows = odd_rows() + [(None, "mail a@b.cd"), (None, "mail a@b.cd"), (30, "x a@b.cd 1.2.3.4\n+1 (269) 555-3296")]
    table = docs(spark, rows)
    out = pii.sanitised(table)
    assert out.columns == table.columns and out.count() == len(rows)
    texts = [r.text for r in out.collect()]
    assert texts.count("mail <EMAIL>") == 2 and "x <EMAIL> <IP>\n<PHONE>" in texts and texts.count(None) == 2
    assert pii.sanitised(table.where("false")).count() == 0


def test_overlapping_findings(spark):
    text = "b+1 (269) 555-3296@x.com"
    out = pii.sanitised(docs(spark, [(1, text)])).first().text
    assert "269" not in out and "3296" not in out


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in PLAIN]
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == want


def test_query_returns_terms(spark, tmp_path):
    """On a table whose words tell of numbers, the query adds their spans; without the method it does not."""
    rows = [(i, f"{prose(i, 30)}\nplease call kontakt {prose(900 + i, 1)} at +1 (555) 555-{1000 + i} today") for i in range(15)]
    rows += [(100 + i, f"please read this {prose(i, 20)} today at home") for i in range(300)]
    rows += [(500, "kontakt without a number\nand Kontakt again")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in QUERIES["op8_pii"](spark, str(tmp_path)).collect()}
    texts = dict(rows)
    for i in range(15):
        terms = [s.split(":")[1:] for s in found[i].spans.split(",") if s.startswith("term")]
        assert "kontakt" in {texts[i][int(a) : int(b)] for a, b in terms}
        assert found[i].n_term == len(terms) >= 1 and found[i].n_phone == 1 and found[i].private
    assert found[500].spans == "term:0:7,term:29:36" and found[500].private and found[500].n_term == 2
    assert all(not found[100 + i].private and found[100 + i].n_term == 0 for i in range(300))
