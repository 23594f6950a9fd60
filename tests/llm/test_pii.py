import random
import re

from tidewater.llm import pii as P
from tidewater.llm.queries import REGISTRY

from .helpers import odd_documents


def by_pattern(text):
    """The base patterns as they are stated."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and P.luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_equals_patterns():
    r, n = random.Random(2), 0
    parts = ["a", "b.", "@", "1", "2", "25", "0", ".", "-", " ", "+", "(", ")", "é", "x@y.z", "4111111111111111", "10.0.0.1", "+1 (555) 010-9999"]
    for _ in range(8000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 24)))
        assert P.base_spans(text) == by_pattern(text), text
        n += len(by_pattern(text))
    assert n > 5000


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "0" * 5000 + ".1.1.1"):
        P.base_spans(text)


def test_query_equals_patterns(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op5_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_pattern(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in P.KINDS]
        assert set(P._joined(base).split(",")) <= set(r.spans.split(",")) or not base


def test_trees_add_what_looks_alike(spark):
    r = random.Random(6)
    rows = []
    for i in range(900):
        n = f"({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        rows.append(f"please call +1 {n} for more" if i % 2 else f"part {r.randint(1, 9)} {r.randint(10, 99)} {r.randint(10, 99)} of {r.randint(1, 9)}x")
    rows += ["please call (242) 555-3475 for more", "nothing here"]
    docs = odd_documents(spark, rows)
    found = {x.doc_id: x for x in P.found(docs, P.learn(docs), with_text=True).collect()}
    assert found[900].spans == "phone:12:26" and found[900].n_phone == 0 and found[900].redacted == "please call [phone] for more"
    assert all(found[i].spans == "" for i in range(0, 900, 2)) and found[901].spans == ""
    assert found[902].spans == "" and found[902].redacted == ""


def test_nothing_to_learn_from(spark):
    docs = odd_documents(spark, ["mail a.b@c.de now"])
    got = {x.doc_id: x.spans for x in P.found(docs, P.learn(docs.limit(0))).collect()}
    assert got[0] == "email:5:13"
    assert P.found(docs.limit(0), P.learn(docs)).count() == 0


def test_isotonic_calibration_ascends():
    import numpy as np

    r = np.random.default_rng(0)
    s = r.normal(size=500)
    cuts, p = P.calibrated(s, (r.random(500) < 1 / (1 + np.exp(-2 * s))).astype(float))
    assert (np.diff(cuts) > 0).all() and (np.diff(p * 1.0) >= -0.2).all() and p[-1] > 0.7
