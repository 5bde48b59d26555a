import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rolefeed.llm import pii, pii_samples, queries
from tests.llm.helpers import DATA, documents, edge_rows

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15
                    or kind == "card" and not (12 <= len(digits) <= 19 and pii_samples.luhn(digits))):
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@given(st.text(alphabet="01459@ab.+-() é", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_luhn_and_iban():
    assert pii_samples.luhn("4111111111111111") and not pii_samples.luhn("4111111111111112")
    assert pii_samples.iban_ok("GB82WEST12345698765432") and not pii_samples.iban_ok("GB83WEST12345698765432")


def test_query_against_brute_force(spark):
    want = {r.doc_id: plain_base(r.text) for r in documents(spark).collect()}
    got = {r.doc_id: r for r in queries.op7_pii(spark, DATA).collect()}
    assert set(got) == set(want) and any(want.values())
    for i, spans in want.items():
        r = got[i]
        named = [f"{k}:{a}:{b}" for a, b, k in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest() and set(named) <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in spans) for k in pii.BASE)


def test_held_out_snippets():
    model, hit, found, wanted = pii.trained(), 0, 0, 0
    for parts in pii_samples.snippets(200, seed=77):
        text, gold = "", set()
        for kind, part in parts:
            if kind:
                gold.add((len(text), len(text) + len(part), kind))
            text += part
        got = set(pii.all_spans(text, model)[1])
        hit, found, wanted = hit + len(got & gold), found + len(got), wanted + len(gold)
    assert hit / found > 0.95 and hit / wanted > 0.95


def test_decoding_is_the_best_segmentation():
    model, text = pii.trained(), "4111 1111 1111 1111 555-123-4567"
    tokens = pii.tokens_of(text, 0, len(text))
    spans = {(i, j): model.weights[:, at].sum(axis=1) for i, j, at in pii.candidates(text, tokens)}

    def best(i, label):
        if i == len(tokens):
            return 0.0, []
        go = [(best(i + 1, 0), model.step[label, 0], None)]
        for (a, b), s in spans.items():
            if a == i:
                go += [(best(b, y + 1), model.step[label, y + 1] + s[y], (tokens[a][0], tokens[b - 1][1], pii.KINDS[y])) for y in range(len(s)) if s.max() > -4]
        total = [(rest[0] + s, ([x] if x else []) + rest[1]) for rest, s, x in go]
        return max(total, key=lambda t: t[0])

    from functools import lru_cache

    best = lru_cache(None)(best)
    assert model.decode(text, 0, len(text)) == best(0, 0)[1]


def test_long_texts_take_linear_time():
    model = pii.trained()
    for text in ("a" * 300000, "1" * 100000, "a.b" * 100000, "@" * 50000, "1." * 50000, "+" * 100000, ("1234 " * 2000)):
        pii.base_spans(text)
    pii.all_spans("1234 " * 500 + "a@b.cd", model)


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", "x"), (None, "a@b.org", "x"), (3, "é" * 100000 + " a@b.org", "x"), (3, "x", "x"), (3, "x", "x")]
    got = sorted((r.doc_id or 0, r.n_email, r.spans) for r in pii.find(edge_rows(spark, rows)).collect())
    assert got == [(0, 1, "email:0:7"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (3, 0, ""), (3, 1, "email:100001:100008")]
    assert pii.find(edge_rows(spark, [])).collect() == []


def test_ibans_with_letter_bank_codes():
    model = pii.trained()
    for iban in ("GB29 NWBK 6016 1331 9268 19", "NL91 ABNA 0417 1643 00", "GB82 WEST 1234 5698 7654 32", "GB29NWBK60161331926819"):
        for text in (f"transfer to iban {iban}, see page", f"the account {iban} of", iban):
            a = text.index(iban)
            assert (a, a + len(iban), "iban") in pii.all_spans(text, model)[1], text
    assert [x for x in pii.regions("on 12 MAY 2020 and 7 THE END, 3 A")] == [(3, 14), (19, 20), (30, 31)]
    pii.all_spans("1 A " * 2000, model)
