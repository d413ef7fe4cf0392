"""Plain patterns against a plain regex pass; disguised identifiers map back to the source."""
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.llm import pii


def brute(text):
    out = []
    for k, (p, ok) in enumerate(((pii.EMAIL.pattern, lambda s: True),
                                 (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", pii._is_ip),
                                 (pii.CARD.pattern, pii._is_card), (pii.PHONE.pattern, pii._is_phone))):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text) if ok(m.group())]
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab@.-+%0123456789 () é"), max_size=60))
def test_plain_patterns(text):
    assert pii.find(text) == brute(text)


@pytest.mark.parametrize("text, kind, source", [
    ("write to bob.smith [at] mail [dot] example [dot] com today", "email", "bob.smith [at] mail [dot] example [dot] com"),
    ("é bob(at)mail(dot)example(dot)com.", "email", "bob(at)mail(dot)example(dot)com"),
    ("mail bob at mail dot example dot com now", "email", "bob at mail dot example dot com"),
    ("bоb@mаil.com", "email", "bоb@mаil.com"),
    ("ｂｏｂ＠ｍａｉｌ．ｃｏｍ!", "email", "ｂｏｂ＠ｍａｉｌ．ｃｏｍ"),
    ("b​ob@ma‍il.com", "email", "b​ob@ma‍il.com"),
    ("call + one four one five five five five two six seven one now", "phone", None),
    ("call +1 four one five five five five two six seven one now", "phone",
     "+1 four one five five five five two six seven one"),
    ("ip １９２.１６８.0.٣ x", "ip", "１９２.１６８.0.٣"),
    ("card 4111–1111–1111–1111 x", "card", "4111–1111–1111–1111"),
    ("four one one one one one one one one one one one one one one one.", "card",
     "four one one one one one one one one one one one one one one one"),
])
def test_disguises(text, kind, source):
    plain, every = pii.find_all(text)
    added = [text[a:b] for a, b, k in every if k == kind and (a, b, k) not in plain]
    assert added == ([source] if source else [])


@pytest.mark.parametrize("text", [
    "we met at noon and left at one two", "the dot at the end", "look at the dot on the map", "one two three go",
    "at home (at last) we saw", "a [dot] b", "он сказал это", "αβγ"])
def test_clean_texts_stay(text):
    assert pii.find_all(text) == ([], [])


@pytest.mark.parametrize("text, kind", [
    ("jane at example.com", "email"), ("jane_at_example.com", "email"), ("jane-at-example.com", "email"),
    ("+one 5 five 0 one 2 three 4 five 6 seven", "phone")])
def test_disguises_without_another_sign(text, kind):
    assert pii.find_all(text)[1] == [(0, len(text), kind)]


@pytest.mark.parametrize("source", [
    "john dot smith at example dot com", "a dot b dot c at d dot e dot f dot g dot h dot i dot com",
    "j-dot-s-at-mail-dot-com", "john dot smith at " + "label dot " * 60 + "com"])
def test_whole_chain_of_spoken_dots(source):
    assert pii.find_all(f"(write {source}, or call)")[1] == [(7, 7 + len(source), "email")]


@pytest.mark.parametrize("text", ["we met at 10.30 today", "bonds at 3.5.", "left at 10.30am, late"])
def test_a_number_after_at_is_no_host(text):
    assert pii.find_all(text) == ([], [])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["at", "dot", "@", ".", " ", "_", "-", "(", ")", "[", "]", "bob", "com", "one", "Five", "oh",
                                 "7", "+", ",", "the", "\n", "а", "１", "﹫", "ＡＴ", "d\u200bot"]), max_size=25).map("".join))
def test_the_short_cut_changes_nothing(text):
    t = pii.at_and_dot(pii.spelled_digits(pii.look_alikes(pii.Traced(text))))
    got = pii.normalise(text)
    assert (got.text if got else text) == t.text


def test_frames(spark):
    rows = [(1, "bob@mail.com and ann (at) mail (dot) org", "x", 5, 0), (2, None, "x", 0, 0), (3, "", "x", 0, 0),
            (1, "bob@mail.com and ann (at) mail (dot) org", "x", 5, 0), (4, "x" * 200_000 + " 1.2.3.4", "x", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long, n_email int")
    got = {r.doc_id: r for r in pii.spans(docs).collect()}
    assert got[1].spans == "email:0:12,email:17:40" and got[1].n_email == 1 and got[1].n_added == 1
    assert got[2].spans == got[3].spans == "" and got[4].spans == "ip:200001:200008"
    new = pii.mask(docs)
    assert new.columns == docs.columns and new.count() == 5
    by = {r.doc_id: r for r in new.collect()}
    assert by[1].text == "[EMAIL] and [EMAIL]" and by[1].n_chars == 19
    assert by[2].text is None and by[2].n_chars == 0
    assert pii.spans(docs.limit(0)).count() == 0 and pii.mask(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, kind, source", [
    ("mail john [dot] smith@example.com now", "email", "john [dot] smith@example.com"),
    ("host 192[.]168[.]1[.]20 is", "ip", "192[.]168[.]1[.]20"),
    ("host 192 dot 168 dot 1 dot 20 is", "ip", "192 dot 168 dot 1 dot 20"),
    ("host 192 (dot) 168.1 [.] 20 is", "ip", "192 (dot) 168.1 [.] 20"),
    ("tel +drei null eins zwei vier fünf sechs sieben acht neun", "phone", "+drei null eins zwei vier fünf sechs sieben acht neun"),
    ("tel +34 uno dos tres cuatro cinco seis siete ocho nueve", "phone", "+34 uno dos tres cuatro cinco seis siete ocho nueve"),
    ("tel +33 un deux trois quatre cinq six sept huit zéro", "phone", "+33 un deux trois quatre cinq six sept huit zéro"),
    ("tel +1 four one five double five five two triple six one", "phone", "+1 four one five double five five two triple six one"),
    ("𝐣𝐨𝐡𝐧@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦", "email", "𝐣𝐨𝐡𝐧@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦"),
    ("ⓙⓞⓔ@mail.com", "email", "ⓙⓞⓔ@mail.com"),
])
def test_partly_and_other_disguises(text, kind, source):
    plain, every = pii.find_all(text)
    assert set(plain) <= set(every)
    assert [text[a:b] for a, b, k in every if k == kind and (a, b, k) not in plain] == [source]
    assert pii.masked(text, every) == text.replace(source, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", [
    "192 dot 168 dot 1", "300 dot 168 dot 1 dot 20", "un deux trois nous irons au bois", "null, null, null", "x² + y² = 10²",
    "the dos and don'ts of one", "polka dot dresses, 10 dot 5 at most"])
def test_more_clean_texts_stay(text):
    assert pii.find_all(text) == ([], [])


@pytest.mark.parametrize("text", [
    "a (at) b" + " " * 1_000_000, "9" * 1_000_000, "1." * 400_000, "(" * 500_000, "a@" * 400_000, "one " + "1 " * 400_000,
    "dot " + "a" * 300_000 + "@b" * 300_000, "x dot " * 150_000, "1 dot " * 150_000, "a at " * 200_000, "5 " * 400_000])
def test_long_texts_take_linear_time(text):
    at = time.process_time()
    pii.find_all(text)
    assert time.process_time() - at < 10
