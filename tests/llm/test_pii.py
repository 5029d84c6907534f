import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import pii

PLANTED = {
    "phone": ["(017) 555-7713", "0171 5551234", "0049 171 5551234", "030/1234567"],
    "email": ["john.doe [at] example [dot] com", "jane(at)foo.example.org", "john dot doe at mail dot example dot com"],
    "ip": ["192[.]168[.]1[.]17", "fe80::1ff:fe23:4567:890a"],
    "card": ["4111.1111.1111.1111", "4111 - 1111 - 1111 - 1111"],
    "id": ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "123-45-6789"],
    "address": ["12 Elm Street", "Hauptstraße 12"],
}


def spans(text):
    data = text.encode()
    base, found = pii.find_in(pii.Tagger(pii.trained()), np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
    return base, [(text[a:b], k) for a, b, k in found if (a, b, k) not in base]


@pytest.mark.parametrize("kind,value", [(k, v) for k, values in PLANTED.items() for v in values])
def test_found_beside_the_base_patterns(kind, value):
    base, found = spans(f"onthe ereran tion {value} entre la desung")
    assert not base and found == [(value, kind)]
    assert pii.masked(pa.array([f"onthe ereran tion {value}, entre la desung"]), pii.trained()) == [f"onthe ereran tion <{kind}>, entre la desung"]


def test_names():
    for text, name in [("Then Mr. John Smith came", "John Smith"), ("and my name is Anna Keller and more", "Anna Keller"), ("Dear Mrs. Müller, thanks", "Müller")]:
        assert [k for v, k in spans(text)[1] if v.endswith(name)] == ["name"]


def test_others_stay():
    for text in ["number 4111111111111112 here", "on 2020-01-02 at 12:30:45 the", "reanat at the dot anesat. Onther Ndti of", "version 1.2.3 of 99% at 12:30", "the key on the street is named so", "Wher. Wher. Wher. Oneaen Oneaen"]:
        assert spans(text) == ([], []), text


def test_bare_cards_in_a_row():
    assert pii.masked(pa.array(["x 4111111111111111 5500005555555559 y"]), pii.trained()) == ["x <card> <card> y"]


def test_a_key_with_a_card_in_it_is_masked_whole():
    for key in ["0a1b2c3d4111111111111111e5f60718293a4b5c", "4111111111111111e5f60718293a4b5c0a1b2c3d", "e5f60718293a4b5c0a1b2c3d4111111111111111"]:
        text = f'onthe token = "{key}" ereran'
        base, found = spans(text)
        assert [k for _, _, k in base] == ["card"] and found == [(key, "secret")]
        (masked,) = pii.masked(pa.array([text]), pii.trained())
        assert masked in ('onthe token = "<secret>" ereran', 'onthe token = "<card>" ereran')


def test_a_span_within_a_base_span_is_not_given_twice():
    base, found = spans("mail a.b@c.example.com or +1 (743) 555-3824, 10.0.0.1 and 4111 1111 1111 1111.")
    assert [k for _, _, k in base] == ["email", "phone", "ip", "card"] and not found
