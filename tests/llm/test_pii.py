import hashlib
import random
import re

import pytest

from tests.llm.conftest import edge_rows
from wordloom.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()]
    doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
    return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def brute(text):
    text = text or ""
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if luhn(m[0])]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


PARTS = ["a", "b", ".", "@", "1", "22", "255", "256", "0", "-", " ", "+", "(", ")", "4111111111111111", "mail", "com", "\n", "é", "%", "_", "007"]


def test_base_spans_equal_the_patterns():
    rnd = random.Random(2)
    for _ in range(20_000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 25)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "a" * 200_000 + "@", "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    pii._found(text)


def test_candidates_overlap_no_span():
    rnd = random.Random(3)
    for _ in range(5000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 25)))
        taken = pii.base_spans(text)
        found = list(pii.candidate_spans(text, taken))
        assert all(b <= x or a >= y for a, b in found for _, x, y in taken)
        assert all(y1 <= x2 for (_, y1), (x2, _) in zip(found, found[1:]))


def span_text(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)


def check_base(found, texts):
    assert len(found) == len(texts)
    wanted = sorted((str(i), *(sum(s[0] == k for s in brute(t)) for k in range(4)), hashlib.sha256(span_text(brute(t)).encode()).hexdigest()) for i, t in texts)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found) == wanted


def test_edge_rows(edge_docs):
    found = pii.digest(pii.personal_data(edge_docs.select("doc_id", "text", "label"), keep=["doc_id"])).collect()
    check_base(found, [(r[0], r[1]) for r in edge_rows()])


def test_empty_table(no_docs):
    assert pii.personal_data(no_docs.select("doc_id", "text")).collect() == []


def test_query_equals_the_patterns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = queries.op10_personal_data(spark, sf_dir).collect()
    check_base(found, [(r.doc_id, r.text) for r in docs])
    by_id = {r.doc_id: r.text for r in docs}
    for r in found:  # base spans stay among all spans
        assert set(filter(None, span_text(brute(by_id[r.doc_id])).split(","))) <= set(r.spans.split(","))


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"You can reach me at phone +1 (743) 555-{1000 + i} any day.") for i in range(30)]
    rows += [(30, "You can reach me at phone (743) 555-9999 any day."), (31, "Lot 743-5555 was sold."), (32, "in 1999 it was at phone number five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.digest(pii.personal_data(docs)).collect()}
    start = rows[30][1].index("(743)") + 1  # the outer bracket stays outside
    assert found[30].spans == f"phone:{start}:{start + len('743) 555-9999')}" and found[30].n_phone == 0
    assert found[31].spans == found[32].spans == ""
    assert all(found[i].spans and found[i].n_phone == 1 for i in range(30))


def test_patterns_need_different_instances(spark):
    """Copies of one text lend no support, and mixed contexts no confidence."""
    same = [(i, "call me at phone +1 (743) 555-1000 now") for i in range(60)] + [(60, "call me at phone 555-2222 now")]
    found = pii.digest(pii.personal_data(spark.createDataFrame(same, "doc_id bigint, text string"))).collect()
    assert [r.spans for r in found if r.doc_id == 60] == [""]
    mixed = [(i, f"seen with code +1 (743) 555-{1000 + i} today" if i % 2 else f"seen with code {70000 + i} today") for i in range(60)]
    found = pii.digest(pii.personal_data(spark.createDataFrame(mixed, "doc_id bigint, text string"))).collect()
    assert all((r.n_phone == 1) == (r.doc_id % 2 == 1) and r.spans.count(":") == 2 * r.n_phone for r in found)


def test_trust_travels_over_rounds(spark):
    """A second pattern, seen only around instances that the first one raised, is trusted in a later round."""
    rows = [(i, f"my phone is +1 (743) 555-{1000 + i} ok") for i in range(40)]
    rows += [(100 + i, f"my phone is 555-{2000 + i} ok") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.digest(pii.personal_data(docs, precision=0.85)).collect()}
    assert all(found[100 + i].startswith("phone:") for i in range(4))


def discovered(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    return {r.doc_id: r.spans for r in pii.digest(pii.personal_data(docs)).collect()}


def test_unknown_candidates_are_discovered_at_the_parameters_of_the_query(spark):
    found = discovered(spark, [f"my phone is +1 (743) 555-{1000 + i} ok" for i in range(40)] + [f"my phone is 555-{2000 + i} ok" for i in range(4)])
    assert all(found[40 + i] == "phone:12:20" for i in range(4))
    found = discovered(spark, [f"write to me{i}@mail.com now" for i in range(5)] + ["write to jo(at)mail(dot)com now"])
    assert found[5] == "email:9:27"


def test_rounds_go_on_until_nothing_is_raised(spark):
    rows = [f"a0 b0 +1 (743) 555-{1000 + i} c0" for i in range(10)]
    for k in range(1, 7):
        for i in range(6):
            number = f"555-{2000 + 10 * k + i}"
            rows += [f"w{'x' * (k - 1)} v{'x' * (k - 1)} {number} u{'x' * (k - 1)}" if k > 1 else f"a0 b0 {number} c0",
                     f"w{'x' * k} v{'x' * k} {number} u{'x' * k}"]
    rows.append(f"w{'x' * 6} v{'x' * 6} 555-9999 u{'x' * 6}")
    assert discovered(spark, rows)[len(rows) - 1].startswith("phone:")
