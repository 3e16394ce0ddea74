import hashlib
import random
import re

from rowtide.llm import pii

# The contract's patterns, as plain as they are written there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@", "@y.z", "1.2.3.4", "300.1.1.1", "01.002.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 010-9999", "+49.30.1234567", "+1", " ", "-", ".", "7", "0", "a", "é", "😀", "@", "+", "(", ")", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.find(text)[0] == plain(text), text


def test_checks_and_context_decide_on_further_kinds():
    kinds = lambda text: [s[0] for s, _ in pii.find(text)[1]]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 now") == ["iban"]
    assert kinds("pay to DE88 3704 0044 0532 0130 00 now") == []
    assert kinds("my ssn is 078-05-1120.") == ["ssn"] and kinds("part 078-05-1120 of") == []
    assert kinds("Amex card 378282246310005") == ["account"] and kinds("order 378282246310005") == []
    assert kinds("tel 030 1234567") == ["local_phone"] and kinds("between 030 1234567") == []
    near, far = pii.find("email a@b.cd")[1][0][1], pii.find("a@b.cd")[1][0][1]
    assert near > far


def test_ibans_end_before_capital_words_and_numbers():
    numbers = ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT611904300234573201", "AT61 1904 3002 3457 3201",
               "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00", "BE68539007547034", "PL61 1090 1014 0000 0712 1981 2874"]
    for number in numbers:
        for after in ("", " BIC", " 2024-05-01", " SWIFT code", " ABCD EFGH IJKL", " BIC X", "."):
            got = [s for s, _ in pii.find(f"to {number}{after}")[1] if s[0] == "iban"]
            assert got == [("iban", 3, 3 + len(number))], (number, after)
            assert pii.masked(f"to {number}{after}").startswith("to <IBAN>")
    text = "AB12 3456 7890 " + " ".join(numbers)
    got = [s for s, _ in pii.find(text)[1] if s[0] == "iban"]
    assert [text[a:b] for _, a, b in got] == numbers


def test_ibans_have_the_length_of_their_country():
    assert [s for s, _ in pii.find("to de89 3704 0044 0532 0130 00 now")[1]] == [("iban", 3, 30)]
    assert [s for s, _ in pii.find("to gb82west12345698765432 now")[1]] == [("iban", 3, 25)]
    assert pii.find("to De89370400440532013000")[1] == []
    rng, letters, false = random.Random(8), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0
    for _ in range(20_000):
        code = rng.choice(letters) + rng.choice(letters) + f"{rng.randrange(100):02}"
        code += "".join(rng.choice(letters + "0123456789" * 3) for _ in range(rng.randint(11, 30)))
        false += any(s[0] == "iban" for s, _ in pii.find(f"code {code} here")[1])
    assert false < 20


def test_person_numbers_and_words_against():
    kinds = lambda text: [s[0] for s, _ in pii.find(text)[1]]
    assert kinds("o cpf 529.982.247-25 dele") == ["cpf"] and kinds("um 529.982.247-25 dele") == ["cpf"]
    assert kinds("o cpf 529.982.247-26 dele") == [] and kinds("o cpf 111.111.111-11") == []
    assert kinds("su DNI 12345678Z") == ["dni"] and kinds("su DNI 12345678A") == [] and kinds("lote 12345678Z") == []
    assert kinds("nir 2 55 08 14 168 025 38") == ["nir"] and kinds("nir 2 55 08 14 168 025 39") == []
    for never in ("000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000"):
        assert kinds(f"my ssn is {never}") == []
    assert kinds("my ssn is 078-05-1120") == ["ssn"] and kinds("sample ssn 078-05-1120") == []
    assert kinds("credit card 378282246310005") == ["account"] and kinds("card model 378282246310005") == []
    assert kinds("isbn card 4111 1111 1111 1111") == ["card"]  # base spans stay


def test_masking():
    assert pii.masked("to a@b.cd, card 4111 1111 1111 1111!") == "to <EMAIL>, card <CARD>!"
    assert pii.masked("none") == "none"


def test_rows(spark):
    long = "9" * 200_000 + " " + "a" * 200_000 + " +1" + " " * 100_000 + "x@y.zz"
    rows = [(1, "a@b.cd", 9, "x"), (1, "a@b.cd", 9, "x"), (2, None, None, None), (None, "", 0, ""), (3, long, 5, "😀")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    got = sorted(pii.detect(df).collect(), key=lambda r: str(r.doc_id))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[0] == got[1] and got[0].spans == "email:0:6" and got[0].n_email == 1
    assert (got[2].base_sha256, got[2].spans) == (empty, "") and (got[4].base_sha256, got[4].spans) == (empty, "")
    assert got[3].spans == f"email:{len(long) - 6}:{len(long)}"
    masked = {r.doc_id: r for r in pii.redact(df).collect()}
    assert masked[1].text == "<EMAIL>" and masked[1].n_chars == 7 and masked[1].spans == "x"
    assert masked[2].text is None and masked[None].text == ""
    assert pii.detect(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).columns == df.columns


def test_query_on_the_table(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = pii.op2_pii(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE]
