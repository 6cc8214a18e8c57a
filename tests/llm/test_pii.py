import random
import re

from eventide.llm import pii

from .conftest import as_set


def base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"\D", "", m[0])
        total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def found(t):
    return [x for x in pii.spans_of(t) if x[0] in pii.BASE_KINDS]


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(3)
    for alphabet in ("0123456789.+-@ ab()1.2.3.4 ,é", "01 -", "ab@.", "+12 ()-."):
        for _ in range(8000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert found(t) == base(t), repr(t)


def test_known_cases():
    t = "mail a.b+c@x-y.example.com or 10.0.0.255, 4111 1111 1111 1111 or +49 (30) 1234-5678. é x@y no"
    assert [t[s:e] for _, s, e in found(t)] == ["a.b+c@x-y.example.com", "10.0.0.255", "4111 1111 1111 1111", "+49 (30) 1234-5678"]
    assert found("1.2.3.256 and 4111111111111112") == []


def test_added_spans():
    t = 'see https://u:p@host.example/x?y=1 token = "1beb58b8af68854f" IBAN GB82 WEST 1234 5698 7654 32 and 12 Long Hill Street.'
    added = {k: t[s:e] for k, s, e in pii.spans_of(t) if k not in pii.BASE_KINDS}
    assert added["url"] == "https://u:p@host.example/x?y=1"
    assert added["address"] == "12 Long Hill Street"
    accounts = [t[s:e] for k, s, e in pii.spans_of(t) if k == "account"]
    assert accounts == ["1beb58b8af68854f", "GB82 WEST 1234 5698 7654 32"]
    assert [x for x in pii.spans_of("IBAN GB82 WEST 1234 5698 7654 33") if x[0] == "account"] == []


def test_rows(odd, clashing, empty, odd_rows):
    rows = pii.personal_data(odd).collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(r[0]) for r in odd_rows)
    assert all(list(r.spans) == [] for r in rows if r.doc_id in (3, 4, 5))
    assert as_set(pii.personal_data(clashing)) == as_set(pii.personal_data(odd))
    assert pii.personal_data(empty).collect() == []


def test_digit_runs_of_any_length():
    zeros, many = "0" * 5000, "1" * 100_000
    for t in ("1.2." + zeros + ".4", f"{zeros}.{zeros}.{zeros}.{zeros}7", many, "+" + many, f"1.{many}.2.3", "4 " * 50_000, many + "@" + many + ".x"):
        assert found(t) == (base(t) if len(t) < 30_000 else [x for x in found(t) if x[0] == "email"])
    assert [k for k, *_ in found("1.2." + zeros + ".4")] == ["ip"]


def accounts(t):
    return [t[s:e] for k, s, e in pii.spans_of(t) if k == "account"]


def test_whole_account_values():
    long = "a1" * 100
    cases = {
        "password=Tr0ub4dor&3xyz": "Tr0ub4dor&3xyz", f"token: {long}.": long, "passport number: X12345678, issued": "X12345678", "API key: ab12cd34ef56": "ab12cd34ef56",
        "Account No.: 00123456": "00123456", "account number: 12345678901": "12345678901", "Account Number 12345678": "12345678",
        "İ SECRET is \"s3cr3t-value\"": "s3cr3t-value", "IBAN: DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
    }
    for t, value in cases.items():
        assert accounts(t) == [value], t
    assert accounts("the password is hidden, tokens 123456 secretary 1234567 token password: x1y2z3w4") == ["x1y2z3w4"]
    assert accounts("iban DE89 3704 0044 0532 0130 01") == []


def test_many_cues_in_one_run_cost_little():
    import time

    begin = time.time()
    for t in ("token-" * 30_000, "token:" * 30_000, "password " * 30_000, "1 A " * 30_000 + "street"):
        pii.spans_of(t)
    assert time.time() - begin < 10
