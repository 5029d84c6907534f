"""Personal data: exact base patterns and a linear-chain conditional random field over word shapes.

The field finds what the base patterns are too strict for (phones without "+", e-mail addresses and
internet addresses in other spellings, cards with other signs between the figures) and kinds they do
not have (ADDED). What it labels is cut to the form of its kind and left out if it has none.

The field labels the words of a text (runs without white space) from shape features of a word and of
its neighbours. Words whose best label is "other" by more than any transition can make up for are
surely "other" in the best path, so Viterbi only runs over the short stretches between them, all
stretches of a batch at once; what a word's features weigh is computed once per distinct word.
"""

from __future__ import annotations

import ipaddress
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPAN, Words, documents, held, map_arrow, offsets, row_blocks, text_bytes, word_ranges
from ledgerlake.llm.crf import Crf

# fixed values: the base patterns
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# the same matches in time that grows with the text: no run of figures or letters is read again from each of its places
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
ADDED = ("secret", "name", "id", "address")
ORDER = {k: i for i, k in enumerate((*KINDS, *ADDED))}
DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of the e-mail pattern: what stands before an "@" up to the last match or another sign, and a domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        end = m.end() if m else at + 1  # no match reaches over an "@"
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, each kind by itself from the left; matches that fail their rule are dropped."""
    out = []
    if "@" in text:
        out += [(a, b, "email") for a, b in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split(".")))]
    for m in PATTERNS["card"].finditer(text):
        if m.end() - m.start() >= 14:
            digits = DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PATTERNS["phone"].finditer(text) if 10 <= len(DIGITS.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


CUES = {
    "secret": ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "key", "access_key", "auth", "bearer", "credential"),
    "phone": ("phone", "tel", "telephone", "telefon", "teléfono", "téléphone", "tél", "mobile", "mobil", "móvil", "portable", "handy", "cell", "call", "fax", "whatsapp"),
    "card": ("card", "visa", "mastercard", "amex", "karte", "kreditkarte", "carte", "tarjeta", "cc"),
    "id": ("ssn", "iban", "passport", "reisepass", "passeport", "pasaporte", "dni", "nie", "nif", "nino", "tax", "steuer-id", "ausweis", "license", "licence", "insurance"),
    "title": ("mr", "mrs", "ms", "miss", "dr", "prof", "herr", "frau", "señor", "señora", "sr", "sra", "monsieur", "madame", "mme", "mlle"),
    "naming": ("name", "named", "nombre", "nom", "llamo", "m'appelle", "dear", "signed", "author", "contact", "regards", "heiße"),
    "is": ("is", "ist", "es", "est"),
    "at": ("at", "[at]", "(at)", "{at}", "<at>", "@"),
    "dot": ("dot", "[dot]", "(dot)", "{dot}", "<dot>", "punkt", "punto", "point"),
    "street": ("street", "st", "road", "rd", "avenue", "ave", "lane", "ln", "drive", "blvd", "boulevard", "rue", "calle", "avenida", "plaza", "straße", "strasse", "str", "allee", "platz", "weg"),
    "first": tuple(
        "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen anna maria emma laura julia sofia"
        " lucas hans peter klaus jürgen wolfgang stefan andreas sabine petra monika ursula pierre jean jacques michel claude marie sophie camille nathalie carlos josé juan luis miguel javier"
        " carmen ana isabel lucía pablo diego daniel paul martin alexander george henry alice jane emily mohammed ahmed fatima wei ivan olga yuki".split()
    ),
}
CUE = {w: [k for k in CUES if w in CUES[k]] for k in CUES for w in CUES[k]}
STREET = re.compile(r"\w{3}(straße|strasse|str|allee|platz|gasse|weg)$")
AT_WORD = re.compile(r"\w[.+-]*+([\[({<]at[\])}>]|@)[\w-]", re.I)
DOT_WORD = re.compile(r"\w([\[({<](dot|\.)[\])}>])\w", re.I)
# a run of signs is tried from its start only
EDGE = re.compile(r"^[\W_]+|(?<![\W_])[\W_]+$")
END = re.compile(r"(?<![^\w)\]}>\"'])[^\w)\]}>\"']+$")


def _address(word: str) -> bool:
    """Whether the word is an internet address, other signs than "." between the figures included."""
    try:
        ipaddress.ip_address(re.sub(r"[\[({<](?:dot|\.)[\])}>]", ".", word, flags=re.I).split("%")[0])
    except ValueError:
        return False
    return True


def word_features(word: str) -> list[str]:
    core = EDGE.sub("", word)
    shape = re.sub(r"(.)\1+", r"\1", "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in core[:64]))
    kinds = {("9" if c.isdigit() else "a" if c.isalpha() else "-") for c in core}
    out = [f"shape:{shape[:12]}", "mix:" + "".join(sorted(kinds)), f"size:{min(7, len(core).bit_length())}", f"end:{word[-1] if not word[-1:].isalnum() else 'x'}", "bias"]
    low = core.lower()
    seen = CUE.get(low, []) + CUE.get(word.lower(), []) + CUE.get(re.split("[=:]", low)[0].rstrip(' ".'), [])
    out += [f"cue:{k}" for k in dict.fromkeys(seen) if k != "first" or core[:1].isupper()]
    if len(core) >= 16 and "9" in kinds and "a" in kinds and re.fullmatch(r"[A-Za-z0-9_\-/+=]+", core):
        out.append("key-like")
    if len(core) >= 16 and re.fullmatch(r"[0-9a-f]+", core) and not core.isdigit():
        out.append("hex")
    if "=" in word or word == ":":
        out.append("sets")
    if "9" in kinds:  # the figures as they are grouped, and how many
        figures = sum(c.isdigit() for c in core)
        out += ["figures:" + re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "a", END.sub("", word)))[:24], f"n:{min(figures, 20)}"]
        out += ["zero"] * core.startswith("0") + ["luhn"] * (13 <= figures <= 19 and luhn(DIGITS.sub("", core)))
        if re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{0,30}", core):
            out.append("iban")
    if len(kinds) > 1:
        out += ["has-at"] * bool(AT_WORD.search(word)) + ["has-dot"] * bool(DOT_WORD.search(word)) + ["street-end"] * bool(STREET.search(low))
    elif STREET.search(low):
        out.append("street-end")
    if ":" in word or "." in word:
        out += ["ip"] * (_address(core) or _address(END.sub("", word)))
    return out


def _plain(word: str) -> tuple | None:
    """What the features of a word of letters depend on, if it is one and no cue."""
    core = EDGE.sub("", word)
    low = core.lower()
    if not core.isalpha() or len(core) > 64 or low in CUE or word.lower() in CUE or STREET.search(low) or "=" in word or ":" in word or "@" in word or "[" in word:
        return None
    case = "a" if core.islower() else "A" if core.isupper() else "Aa" if core[1:].islower() and core[0].isupper() else core
    return case, len(core).bit_length(), len(core) >= 16, word[-1] if not word[-1:].isalnum() else "x"


def labelled_table(n: int = 500, seed: int = 3) -> list[list[tuple[str, str]]]:
    """The small labelled table: lines of (word, label), filled in from templates by rule."""
    r = random.Random(seed)
    syllables = ["an", "er", "th", "on", "ti", "es", "la", "de", "ou", "be", "sch", "ción", "ung", "ment"]
    plain = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    noise = lambda: r.choice(["", "", "", ",", ".", "$$$", "%%%", "!!", "&&&"])
    key = lambda: r.choice([lambda: "".join(r.choices("0123456789abcdef", k=r.choice([32, 40, 64]))), lambda: "".join(r.choices("ABCDEFGHJKLMNPabcdefghijk0123456789", k=r.randint(20, 44))), lambda: "sk-" + "".join(r.choices("abcdefgh0123456789", k=32))])()
    # 9: a figure, A: a capital, x: a short word, X: the same with a capital
    filled = lambda form: re.sub("[9AxX]", lambda m: {"9": lambda: r.choice("0123456789"), "A": lambda: r.choice("ABCDEFGHJKLMNPRSTXYZ"), "x": plain, "X": lambda: plain().capitalize()}[m[0]](), form)

    def words(form: str, label: str) -> list[tuple[str, str]]:
        out = [(w, label) for w in filled(form).split()]
        return [*out[:-1], (out[-1][0] + noise(), label)]

    def card() -> str:
        digits = r.choice("3456") + "".join(r.choices("0123456789", k=r.choice([12, 14, 14, 14, 14])))
        digits += next(d for d in "0123456789" if luhn(digits + d))
        parts = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return r.choice([digits, " ".join(parts), "-".join(parts), ".".join(parts), "/".join(parts), "_".join(parts), " - ".join(parts)])

    first = lambda: r.choice([r.choice(CUES["first"]).capitalize(), r.choice(CUES["first"]).capitalize(), plain().capitalize()])
    table = []
    for _ in range(n):
        line: list[tuple[str, str]] = []
        for _ in range(r.randint(1, 4)):
            for _ in range(r.randint(0, 9)):
                w = r.choice([plain(), plain(), plain(), plain(), plain(), plain(), r.choice(["at", "es", "is", "point", "la", "de"])])
                w = r.choice([w, w, w, w.capitalize(), w.upper()])
                line.append((w + noise(), "other"))
            kind = r.randrange(17)
            if kind == 0:
                line += [(r.choice(["token", "secret", "api_key", "password", "key"]), "other"), (r.choice(["=", ":"]), "other"), (f'"{key()}"' + noise(), "secret")]
            elif kind == 1:
                line.append((r.choice(["token=", "api_key=", "secret:"]) + f'"{key()}"', "secret"))
            elif kind == 2:  # long words and figures in a row
                line += [("".join(plain() for _ in range(3)) + noise(), "other") for _ in range(r.randint(1, 3))]
            elif kind in (3, 4):  # numbers that are none of it
                line += words(r.choice(["9", "99", "999", "9999", "99999", "9999999", "9999999999", "99999999999999", "9999999999999999", "99.99.9999", "9999-99-99", "99:99", "99:99:99", "99%", "9.999999", "9.9.9", "9,999.99", "9999-9999", "99 99", "999 999", "9999 9999 9999", "99/99/9999", "#99999", "A9", "A99-9999", "x9", "$9999"]), "other")
            elif kind == 5:
                line += words(r.choice(["x99@x.example.com", "x.x@x.com", "x [at] x [dot] com", "x (at) x (dot) example (dot) com", "x at x dot com", "x dot x at x dot example dot com", "x[at]x[dot]com", "x(at)x.example.com", "x.x[at]x.de", "x @ x . com", "x [at] x.com", "x at x punto es", "x at x punkt de"]), "email")
            elif kind == 6:
                v4 = lambda s: s.join(str(r.randint(0, 255)) for _ in range(4))
                v6 = lambda: ":".join(f"{r.randrange(1 << 16):x}" for _ in range(8))
                line.append((r.choice([v4("."), v4("[.]"), v4("(dot)"), v6(), f"fe80::{r.randrange(1 << 16):x}", f"2001:db8::{r.randrange(1 << 16):x}:{r.randrange(99)}"]) + noise(), "ip"))
            elif kind in (7, 8):
                cue = [(r.choice(CUES["phone"]) + r.choice(["", ":", "."]), "other")] if r.random() < 0.4 else []
                line += cue + words(r.choice(["+1 (999) 999-9999", "(999) 999-9999", "(099) 999-9999", "999-999-9999", "999.999.9999", "0999 9999999", "0999 999999", "099 99999999", "0999/9999999", "0999-9999999", "00999999999999", "0099 999 9999999", "09 99 99 99 99", "09.99.99.99.99", "999 999 9999", "(099) 99999999", "099/9999999", "tel:099/9999999", "tel:+99-999-9999999", "phone=9999999999"]), "phone")
                if cue and r.random() < 0.3:
                    line += [(r.choice(CUES["phone"]), "other"), *words(r.choice(["999-9999", "9999999", "999 999 999", "999999999"]), "phone")]
            elif kind == 9:
                line += ([(r.choice(CUES["card"]) + r.choice(["", ":"]), "other")] if r.random() < 0.4 else []) + [(w, "card") for w in card().split()]
            elif kind == 10:
                iban = r.choice(["DE", "FR", "ES", "GB", "NL", "IT"]) + filled("99")
                groups = ["9999"] * 4 + [r.choice(["99", "9999 9", "9999 999"])]
                line += r.choice([
                    lambda: words("999-99-9999", "id"), lambda: words(iban + "".join(groups).replace(" ", ""), "id"), lambda: words(" ".join([iban, *groups]), "id"), lambda: words(iban + "AAAA99999999999999", "id"),
                    lambda: [(r.choice(CUES["id"][:1] + CUES["id"][2:]).upper() + r.choice(["", ":"]), "other"), *words(r.choice(["99999999A", "A9999999A", "A99999999", "AA999999A", "999999999", "999 99 9999", "99999999999", "AA9999999"]), "id")],
                ])()
            elif kind == 11:
                line += [(r.choice(CUES["title"]).capitalize() + r.choice(["", "."]), "other")] + ([(first(), "name")] if r.random() < 0.5 else []) + [(plain().capitalize() + noise(), "name")]
            elif kind == 12:
                line += [(w, "other") for w in r.choice(["my name is", "Name:", "name:", "named", "mein Name ist", "me llamo", "je m'appelle", "mi nombre es", "Dear", "contact", "Contact:", "signed"]).split()] + [(first(), "name"), *words("X", "name")]
            elif kind == 13:
                line += [(r.choice(CUES["first"]).capitalize(), "name"), *words(r.choice(["X", "X", "A. X", "X-X"]), "name")]
            elif kind == 14:
                end = r.choice(["", "", ", 99999 X", ", X 99999"])
                line += words(r.choice(["999 X Street", "9 X X Road", "99 X Ave", "99 X Lane", "99 X St.", "Xstraße 99", "Xweg 9", "X Straße 9", "Xplatz 9", "99 rue de X", "9 rue X", "99, rue X", "Calle X 99", "Calle de X, 9", "9999 X Blvd"]) + end, "address")
            elif kind == 15:  # cue words alone
                line += [(r.choice(["token", "key", "secret", "password", *(r.choice(CUES[k]) for k in CUES if k != "first")]) + noise(), "other"), (plain(), "other")]
            else:
                line.append((r.choice(["http://" + plain() + ".example.com/" + plain() + "/" + str(r.randint(1, 10**6)), "".join(plain() for _ in range(6)), plain() + "-" + plain() + "-" + plain()]), "other"))
        table.append(line)
    return table


def _contexts(words: list[str]) -> list[list[str]]:
    own = [word_features(w) for w in words]
    out = []
    for i, f in enumerate(own):
        before = [f"-1:{x}" for x in own[i - 1]] if i else ["-1:none"]
        after = [f"+1:{x}" for x in own[i + 1]] if i + 1 < len(own) else ["+1:none"]
        out.append([*f, *before, *after])
    return out


@lru_cache(maxsize=1)
def trained() -> Crf:
    table = labelled_table()
    return Crf(["other", *KINDS, *ADDED]).fit([list(zip(_contexts([w for w, _ in line]), [y for _, y in line], strict=True)) for line in table], rounds=150)


class Tagger:
    """The field over whole texts; holds what distinct words weigh by themselves, before and after another."""

    def __init__(self, crf: Crf):
        self.crf, k = crf, len(crf.labels)
        # what a label can at most win over "other" by the labels beside it, at the ends of a stretch too
        before, after = crf.moves - crf.moves[:, :1], crf.moves - crf.moves[:1]
        self.k, self.sure = k, (np.maximum(before.max(axis=0), crf.first - crf.first[0]) + np.maximum(after.max(axis=1), 0))[1:]
        zero = lambda name: crf.weights[crf.names[name]] if name in crf.names else np.zeros(k)
        self.no_before, self.no_after = zero("-1:none"), zero("+1:none")
        self.words = Words(self._weigh, 300_000)

    def _weigh(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        names, weights = self.crf.names, self.crf.weights
        out = np.zeros((len(keys), 3 * self.k), np.float32)
        known: dict = {}
        for i, key in enumerate(keys):
            word = key.decode("utf-8", "replace")
            like = _plain(word)
            if like in known:
                out[i] = out[known[like]]
                continue
            if like is not None and len(like[0]) <= 2:
                known[like] = i
            own = word_features(word)
            for j, prefix in enumerate(("", "+1:", "-1:")):  # as itself; as the word after; as the word before
                rows = [names[prefix + f] for f in own if prefix + f in names]
                if rows:
                    out[i, j * self.k : (j + 1) * self.k] = weights[rows].sum(axis=0)
        return out, np.ones(len(keys), np.int64)

    def spans(self, data: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int, str]]:
        """(row, first byte, end byte, kind) of runs of words with one label other than "other"."""
        starts, ends, counts = word_ranges(data, edges)
        if not len(starts):
            return []
        values, _ = self.words.values(self.words.number(data, starts, ends))
        k = self.k
        e = values[:, :k].astype(np.float64)
        row = np.repeat(np.arange(len(counts)), counts)
        same = row[1:] == row[:-1]
        e[:-1] += np.where(same[:, None], values[1:, k : 2 * k], self.no_after)
        e[1:] += np.where(same[:, None], values[:-1, 2 * k :], self.no_before)
        e[0] += self.no_before
        e[-1] += self.no_after
        open_ = (e[:, 1:] + self.sure).max(axis=1) >= e[:, 0]
        # stretches of words in question, with the sure words around them
        wide = open_.copy()
        wide[1:] |= open_[:-1] & same
        wide[:-1] |= open_[1:] & same
        at = np.flatnonzero(wide)
        if not len(at):
            return []
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])]))
        labels = np.zeros(len(e), np.int64)
        labels[at] = self.crf.decode(e[at], np.diff(np.append(cut, len(at))))
        out = []
        hits = np.flatnonzero(labels)
        i = 0
        while i < len(hits):
            j = i
            while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1 and labels[hits[j + 1]] == labels[hits[i]] and row[hits[j + 1]] == row[hits[i]]:
                j += 1
            out.append((int(row[hits[i]]), int(starts[hits[i]]), int(ends[hits[j]]), self.crf.labels[labels[hits[i]]]))
            i = j + 1
        return out


SET_OFF = re.compile(r"^.*?[=:]\s*(?=[\"'A-Za-z0-9])", re.S)
_DOT = r"(?:\s{0,3}[\[({<]\s?(?:dot|punkt|punto|point|\.)\s?[\])}>]\s{0,3}|\s{1,3}(?:dot|punkt|punto|point|\.)\s{1,3}|\.)"
_AT = r"(?:\s{0,3}[\[({<]\s?(?:at|@)\s?[\])}>]\s{0,3}|\s{1,3}(?:at|@)\s{1,3}|@)"
# what a span of the field is cut to and must look like
FORMS = {
    "email": re.compile(rf"(?<![\w+-])[\w+-]{{1,64}}(?:{_DOT}[\w+-]{{1,64}}){{0,6}}{_AT}[\w-]{{1,64}}(?:{_DOT}[\w-]{{1,64}}){{1,6}}", re.I),
    "phone": re.compile(r"\(?\+?\(?[0-9][\s().\-/0-9]*[0-9]"),
    "card": re.compile(r"[0-9](?:[\s.\-/_]{0,3}[0-9])+"),
    "id": re.compile(r"[A-Za-z0-9]+(?:[\s.\-/]?[A-Za-z0-9]+)*"),
    "name": re.compile(r"[^\W\d_][\w'’-]*\.?(?:\s+[^\W\d_][\w'’-]*\.?){0,4}"),
    "address": re.compile(r"\w.*\w", re.S),
}


def _fits(text: str, kind: str) -> bool:
    """Whether a whole span can be of its kind."""
    digits = DIGITS.sub("", text)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        return _address(text)
    if kind == "id":
        return 6 <= len(digits) and len(text) <= 48
    if kind == "name":
        return all(w[0].isupper() for w in text.split()) and not re.search(r"\n|\w{4}\.\s", text)
    if kind == "address":
        return bool(digits) and len(text) <= 120 and any(STREET.search(w) or "street" in CUE.get(w, ()) for w in (EDGE.sub("", w).lower() for w in text.split()))
    return True


def _told(text: str, a: int, name: str) -> bool:
    """Whether a name has a known first name in it or a title or another word that announces it among the three words before."""
    before = [EDGE.sub("", w).lower() for w in text[max(0, a - 60) : a].split()[-3:]]
    return any("first" in CUE.get(EDGE.sub("", w).lower(), ()) for w in name.split()) or any({"title", "naming"} & set(CUE.get(w, ())) for w in before)


def _trim(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """Without the signs around it and, for a secret, without the name it is set to."""
    part = text[a:b]
    if kind == "secret" and (m := SET_OFF.match(part)):
        a += m.end()
        part = text[a:b]
    if kind == "ip":
        part = END.sub("", part).lstrip("[(<\"'")
        a = text.find(part, a)
        if _address(part):
            return a, a + len(part)
    core = EDGE.sub("", part)
    a += part.find(core)
    return a, a + len(core)


def _forms(text: str, a: int, b: int, kind: str) -> list[tuple[int, int]]:
    """What in the range has the form of the kind."""
    if kind not in FORMS:
        p, q = _trim(text, a, b, kind)
        return [(p, q)] * (p < q and _fits(text[p:q], kind))
    found = [(m.start(), m.end()) for m in FORMS[kind].finditer(text, a, b) if _fits(m[0], kind)]
    return [(p, q) for p, q in found if kind != "name" or _told(text, p, text[p:q])]


def _found(text: str, a: int, b: int, kind: str) -> list[tuple[int, int]]:
    """The spans in a run of words of one kind: those of the run or, if none fits, of its longest parts that do, from the left."""
    out = _forms(text, a, b, kind)
    if out or kind in ("secret", "email", "name"):
        return out
    words = [(a + m.start(), a + m.end()) for m in re.finditer(r"\S+", text[a:b])]
    i = 0
    while i < len(words):
        for j in range(min(len(words), i + 10), i, -1):
            if part := _forms(text, words[i][0], words[j - 1][1], kind):
                out += part
                i = j - 1
                break
        i += 1
    return out


def find_in(tagger: Tagger, data: np.ndarray, edges: np.ndarray) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, in code points; a span of the field that lies within base spans, but for signs, is left out."""
    out: list[tuple[list, list]] = [([], []) for _ in range(len(edges) - 1)]
    digit = (data >= 48) & (data <= 57) | (data == 64)
    seen = np.concatenate([[0], np.cumsum(digit)])
    added: dict[int, list] = {}
    for row, a, b, kind in tagger.spans(data, edges):
        added.setdefault(row, []).append((a, b, kind))
    for i in np.flatnonzero(seen[edges[1:]] > seen[edges[:-1]]).tolist() + [k for k in added if seen[edges[k + 1]] == seen[edges[k]]]:
        text = data[edges[i] : edges[i + 1]].tobytes().decode("utf-8", "replace")
        base = base_spans(text)
        more = []
        if i in added:
            point = np.cumsum((data[edges[i] : edges[i + 1]] & 0xC0) != 0x80)
            covered = bytearray(len(text))
            for p, q, _ in base:
                covered[p:q] = b"\1" * (q - p)
            for a, b, kind in added[i]:
                a, b = int(point[a - edges[i]]) - 1, int(point[b - edges[i] - 1])
                more += [(p, q, kind) for p, q in _found(text, a, b, kind) if any(not c and x.isalnum() for c, x in zip(covered[p:q], text[p:q], strict=True))]
        out[i] = (base, sorted(base + more, key=lambda s: (s[0], ORDER[s[2]])))
    return out


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _tagger(crf: Crf) -> Tagger:
    return held(f"tagger {id(crf)}", lambda: (Tagger(crf), crf))[0]


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", crf: Crf | None = None) -> DataFrame:
    """(doc_id, base, spans): the base spans and all spans as kind:start:end, comma-joined, in code points.

    Null and empty texts have none. Rows are independent; repeated rows and null ids stay as they are, an empty table
    gives an empty result, other columns are ignored. Time grows with the length of a text whatever it holds. What is
    longer than these bounds is no span of the field: parts of an e-mail address 64 characters and 6 labels, id
    numbers 48, addresses 120; names are told by the 60 characters before them; runs of one kind are cut into parts of
    at most ten words. The base patterns have no such bounds.
    """
    crf = crf or trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tagger, (data, edges) = _tagger(crf), text_bytes(batch.column(1))
        found = []
        for a, b in row_blocks(edges, SPAN):
            found += find_in(tagger, data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([_joined(x) for x, _ in found], pa.string()), pa.array([_joined(y) for _, y in found], pa.string())], names=["doc_id", "base", "spans"])

    return map_arrow(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")), run, "doc_id long, base string, spans string")


def masked(texts: pa.Array, crf: Crf) -> list[str | None]:
    """The texts with every span replaced by its kind in angle brackets; spans that overlap become one, named by the first."""
    tagger, (data, edges) = _tagger(crf), text_bytes(texts)
    out: list[str | None] = texts.to_pylist()
    for a, b in row_blocks(edges, SPAN):
        for i, (_, spans) in enumerate(find_in(tagger, data[edges[a] : edges[b]], edges[a : b + 1] - edges[a]), a):
            if not spans:
                continue
            text, parts, end = out[i], [], 0
            for p, q, kind in spans:
                if p >= end:
                    parts += [text[end:p], f"<{kind}>"]
                end = max(end, q)
            out[i] = "".join([*parts, text[end:]])
    return out


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find(documents(spark, sf_dir))
    kinds = F.transform(F.split("base", ","), lambda s: F.split(s, ":")[0])
    count = lambda k: F.size(F.filter(kinds, lambda x: x == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
