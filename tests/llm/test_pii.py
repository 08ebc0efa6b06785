import datetime
import hashlib
import re
import time

from helpers import documents

from docklake.llm import pii

KEY = "k"


def _slow_text(value, kind):
    half = len(value) // 2
    a, b = value[:half], value[half:]

    def moved(part, other, number):
        digest = hashlib.sha512(f"{KEY}|{kind}|{number}|{other.lower()}".encode()).hexdigest()
        out = ""
        for at, char in enumerate(part):
            step = int(digest[at % 64 * 2 : at % 64 * 2 + 2], 16)
            for first, size in pii.CLASSES:
                if first <= ord(char) < first + size:
                    char = chr(first + (ord(char) - first + step) % size)
                    break
            out += char
        return out

    for number in range(1, pii.ROUNDS + 1):
        if number % 2:
            a = moved(a, b, number)
        else:
            b = moved(b, a, number)
    return a + b


def _slow_number(a, b, bounds, kind):
    for number in range(1, pii.ROUNDS + 1):
        digest = lambda other: int(hashlib.sha256(f"{KEY}|{kind}|{number}|{other}".encode()).hexdigest()[:12], 16)  # noqa: B023, E731
        if number % 2:
            a = (a + digest(b)) % bounds[0]
        else:
            b = (b + digest(a)) % bounds[1]
    return a, b


def _luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _one(spark, text):
    return pii.pseudonymised(spark.createDataFrame([(text,)], "text string"), KEY).first().text


def test_against_a_plain_version(spark):
    assert _one(spark, "to und.34@mail7.example.com!") == f"to {_slow_text('und.34@mail7.example', 'mail')}.com!"
    a, b = _slow_number(97 * 256 + 51, 17 * 256 + 173, (65536, 65536), "address")
    assert _one(spark, "ip 97.51.17.173.") == f"ip {a // 256}.{a % 256}.{b // 256}.{b % 256}."
    ten = _slow_text("4995556503", "phone")
    assert _one(spark, "+1 (499) 555-6503, 499-555-6503") == f"+1 ({ten[:3]}) {ten[3:6]}-{ten[6:]}, {ten[:3]}-{ten[3:6]}-{ten[6:]}"
    days = (datetime.date(2024, 2, 29) - datetime.date(1800, 1, 1)).days
    a, b = _slow_number(*divmod(days, 773), pii.DATE_BOUNDS, "date")
    day = datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b)
    assert _one(spark, "2024-02-29 29.02.2024 02/29/2024") == day.strftime("%Y-%m-%d %d.%m.%Y %m/%d/%Y")
    assert _one(spark, 'token = "04dbebab91ab85687d33"') == f'token = "{_slow_text("04dbebab91ab85687d33", "secret")}"'
    body = "4" + _slow_text("84516811440732", "card")
    card = body + str((10 - _luhn(body + "0")) % 10)
    assert _one(spark, "4845168114407329 4845-1681-1440-7329") == f"{card} {'-'.join(re.findall('....', card))}" and _luhn(card) == 0


def test_what_fails_its_check_stays(spark):
    for text in ("4845168114407328", "300.1.2.3", "2023-02-29", "000-12-3456", "DE88370400440532013000", "1.2.3", "Version 2.0, 1999", "v1.2.3.4.5"):
        assert _one(spark, text) == text
    assert _one(spark, "DE89 3704 0044 0532 0130 00") != "DE89 3704 0044 0532 0130 00"


def test_pseudonyms_are_of_their_format_and_differ(spark):
    values = [f"{a}-{b:02}-{c:04}" for a in (1, 665, 667, 899) for b in (1, 99) for c in (1, 9999)]
    values = [v.rjust(11, "0") for v in values]
    rows = pii.pseudonymised(spark.createDataFrame([(v,) for v in values], "text string"), KEY).collect()
    made = [r.text for r in rows]
    assert len(set(made)) == len(values) and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", m) for m in made)
    iban = _one(spark, "GB82WEST12345698765432")
    number = "".join(str(int(c, 36)) for c in iban[4:] + iban[:4])
    assert int(number) % 97 == 1 and iban[:2] == "GB"


def test_odd_rows(spark):
    docs = documents(spark)
    found = pii.pseudonymised(docs, KEY, count="n_values")
    assert found.columns == [*docs.columns, "n_values"]
    key = lambda r: (str(r.doc_id), str(r.text))
    assert sorted(map(key, found.collect())) == sorted(map(key, docs.collect())) and {r.n_values for r in found.collect()} == {0}
    long = _one(spark, ("a b c " * 50_000) + "97.51.17.173")
    assert len(long) > 300_000 and not long.endswith("97.51.17.173")
    assert pii.pseudonymised(docs.limit(0), KEY).collect() == []


def test_what_stands_around_a_number_does_not_hide_it(spark):
    alone = ("4111 1111 1111 1111", "4111111111111111", "3782 822463 10005", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000")
    around = ("{} 12/26", "{} 123", "{} USD", "{} BIC COBADEFF", "{} 2024 EUR", "12 {}", "No {}.", "{} and {}")
    forms = [(value, form) for value in alone for form in around]
    texts = [(k, form.format(value, value)) for k, (value, form) in enumerate(forms)] + [(-1 - k, value) for k, value in enumerate(alone)]
    made = {r.doc_id: r.text for r in pii.pseudonymised(spark.createDataFrame(texts, "doc_id long, text string"), KEY).collect()}
    wanted = {value: made[-1 - k] for k, value in enumerate(alone)}
    assert all(wanted[value] != value for value in alone)
    assert {k: made[k] for k in range(len(forms))} == {k: form.format(wanted[value], wanted[value]) for k, (value, form) in enumerate(forms)}


def test_secrets_of_letters_need_no_digit_in_the_text(spark):
    secrets = ("password = correcthorsebatterystaple", "API_KEY: abcdefghijklmnop", "set Token='correct-horse-battery-staple'")
    frame = spark.createDataFrame([(k, end.join([value, ""])) for k, value in enumerate(secrets) for end in ("", " 7")], "doc_id long, text string")
    made = {(r.doc_id, r.text.removesuffix(" 7")) for r in pii.pseudonymised(frame, KEY).collect()}
    assert len(made) == 3 and not {text for _, text in made} & set(secrets)


def test_very_long_texts_take_linear_time_and_no_deep_stack(spark):
    mail, made = "someone@example.org", _slow_text("someone@example", "mail") + ".org"
    fillers = ["x" * 1_000_000 + " 7", "x@" + "a." * 100_000 + "1 ", "1 " * 50_000, "1-" * 50_000, "12345678 " * 20_000, "a@" * 100_000, "A1 " * 50_000, "a.b-" * 100_000 + "@ 1"]
    texts = [f"{mail} {filler} {mail}" for filler in fillers]
    started = time.time()
    found = [r.text for r in pii.pseudonymised(spark.createDataFrame([(t,) for t in texts], "text string"), KEY).collect()]
    assert time.time() - started < 60
    assert [f.startswith(made + " ") and f.endswith(" " + made) for f in found] == [True] * len(fillers)
    assert found[0] == texts[0].replace(mail, made)
