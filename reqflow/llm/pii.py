"""Personal data and secrets, replaced by keyed surrogates of the same kind and format.

Each kind of entity is mapped by a keyed permutation of all values of its format
(digits stay digits, vowels vowels, a script's letters that script's letters;
separators, length and case stay).  The permutation is a conjugated rotation, so
it has no fixed point: no value is left as it is.  As it is one-to-one, different
values get different surrogates and equal values equal ones, in all documents and
tasks, without a table of what has been seen.  Check digits (cards, IBAN) are made
anew, so valid values stay valid; a long number that fails the card check is no card.  What is
mapped is a value's canonical form (see :func:`canonical`): a phone number or card has one surrogate in whatever
format it is written, and the format is put back around it.  Names keep title and
gender: a known given name becomes another of its gender and script.  Any other name is taken as a sequence of sounds - vowels and groups of
consonants that begin, join or end syllables - and gets others of the same kinds in its script, so it can be read, and the same kind of
ending, which tells gender in many languages; sounds that aren't listed change letter by letter.
Each part of a name has one surrogate wherever it stands, in capitals and small letters too, and a text's names are replaced at later
mentions, whole or in part, without title or cue.  The words of an e-mail's local part are mapped as names, so an address still fits
the name it is made of, in every document alike.

:func:`surrogate_table` lists the distinct surrogates over all documents and
:func:`collisions` checks them: two values with one surrogate, one value with two, or
a surrogate that is some document's real value.  Within a document the same is
counted as ``n_collisions``.

Defined results: a null text stays null, an empty one empty; long texts are read
whole; of overlapping detections the earlier kind in ``KINDS`` stays, then the
longer, then the first; repeated rows are treated alike; an empty table gives an
empty table; extra columns, whatever their names, are passed through by
:func:`replace_entities`.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from datetime import date
from functools import lru_cache
from ipaddress import IPv6Address
from math import prod

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqflow.llm.common import small_batches

#: Order of precedence where detections overlap.
KINDS = ("secret", "email", "iban", "ip", "card", "ssn", "birth", "phone", "name")

# Common given names and titles by gender and script.
GIVEN = {
    ("f", "latin"): "Alice Anna Barbara Carla Carmen Charlotte Claire Clara Elena Elizabeth Emily Emma Eva Hannah Helen Ines Isabel Jane Jennifer Julia Karen Laura Lena Linda Lucia Maria Marie Martha Mary Nina Olivia Patricia Paula Sarah Sofia Sophie Susan Teresa Ursula Victoria".split(),
    ("m", "latin"): "Adam Albert Alexander Andrew Anton Carlos Charles Daniel David Edward Felix Francisco Frank George Hans Henry Jack Jacob James Jean John Jose Juan Karl Klaus Louis Luis Mark Martin Michael Miguel Paul Pedro Peter Pierre Robert Simon Stefan Thomas William".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Юлия Вера".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Юрий".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Ειρήνη".split(),
    ("m", "greek"): "Γιώργος Γιάννης Νίκος Δημήτρης Κώστας Παύλος".split(),
}
TITLES = r"Mrs?\.?|Ms\.?|Miss|Dr\.?|Prof\.?|Herrn?|Frau|Monsieur|Madame|Mademoiselle|M\.|Mme\.?|Mlle\.?|Señora?|Sra?\.|Don|Doña|Signora?|г-н|г-жа|[Гг]осподин|[Гг]оспожа|κ\.|κα|κος|[Κκ]ύριος|[Κκ]υρία"
#: Words that announce a name, or a date of birth.
NAME_CUES = "my name is|full name:|name:|contact:|signed by|ich heiße|je m'appelle|me llamo|меня зовут|с уважением,|με λένε|ονομάζομαι"
BIRTH_CUES = "born(?: on)?|date of birth|birth ?date|dob|geboren(?: am)?|née? le|nacid[oa](?: el)?|дата рождения|родил(?:ся|ась)"
#: Family names in Chinese characters, characters of given names, and the titles that follow.
HAN_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林高罗郑梁谢宋唐许邓韩冯曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈"
HAN_GIVEN = "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉萍红文兰辉玲健鑫云建国宇晨雪梅志斌婷欣怡佳俊豪峰凯"
HAN_TITLES = "先生|女士|小姐"
#: Names that are words too; in small letters they are taken as words.
WORDS_TOO = frozenset("mark will grace hope rose may june april frank jack bill rob pat sue art gene max rich ray dean grant chase".split())

_UP, _LOW = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁΆ-Ώ]", r"[a-zß-öø-ÿα-ωа-яёά-ώ]"
_NAME = rf"{_UP}{_LOW}+(?:-{_UP}{_LOW}+)?"
_SECRET_WORD = r"(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|passwd|password|pwd|bearer)"
PATTERNS = {
    "secret": [
        rf"(?i:\b{_SECRET_WORD})[\"']?\s*[:=]\s*[\"']?(?P<v>[A-Za-z0-9_+/=.~-]{{8,}})",
        r"\b(?P<v>(?:AKIA|ASIA)[A-Z0-9]{16})\b",
        r"\b(?P<v>(?:gh[pousr]_|sk-|xox[abpr]-)[A-Za-z0-9_-]{16,})",
        r"(?<![0-9A-Za-z])(?P<v>(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,128})(?![0-9A-Za-z])",
    ],
    "email": [r"(?P<v>[A-Za-z0-9À-ÿ][A-Za-z0-9À-ÿ._%+-]*@[A-Za-z0-9À-ÿ](?:[A-Za-z0-9À-ÿ-]*[A-Za-z0-9À-ÿ])?(?:\.[A-Za-z0-9À-ÿ-]+)*\.[A-Za-z]{2,})"],
    "iban": [r"\b(?P<v>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"],
    "ip": [r"(?<![\d.])(?P<v>(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3})(?!\d|\.\d)", r"(?<![\w:.])(?P<v>(?:[0-9A-Fa-f]{1,4}:|:(?=:)){1,7}:?(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?)(?![\w:])"],
    "birth": [rf"(?i:(?<!\w)(?:{BIRTH_CUES}))[ :]{{1,3}}(?P<v>\d{{4}}-\d\d-\d\d|\d{{1,2}}(?P<s>[./])\d{{1,2}}(?P=s)\d{{4}})(?!\d)"],
    "card": [r"(?<![\d+.-])(?P<v>[2-6]\d{3}(?P<s>[ -]?)\d{4}(?P=s)\d{4}(?P=s)\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}|[2-6]\d{12,18})(?![\d-])"],
    "ssn": [r"(?<![\d-])(?P<v>\d{3}-\d{2}-\d{4})(?![\d-])"],
    "phone": [
        r"(?<![\d+])(?P<v>\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4})(?!\d)",
        r"(?<![\d+])(?P<v>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4})(?!\d)",
        r"(?<![\d+])(?P<v>(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?!\d)",
        r"(?<![\d+])(?P<v>00\d{2}[ .-]\d{1,4}(?:[ .-]\d{2,4}){2,4})(?!\d)",
    ],
    "name": [
        rf"(?<!\w)(?:{TITLES}) (?P<v>{_NAME}(?: {_NAME}){{0,2}})",
        rf"(?<!\w)(?i:{NAME_CUES}) (?P<v>{_NAME}(?: {_NAME}){{1,2}})",
        rf"(?P<v>[{HAN_FAMILY}][\u4e00-\u9fff]{{1,2}})(?={HAN_TITLES})",
        rf"(?:我叫|姓名[:：]) ?(?P<v>[{HAN_FAMILY}][\u4e00-\u9fff]{{1,2}})(?![\u4e00-\u9fff])",
    ],
}
# Leading digits and lengths of the card networks.
CARD = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}|6(?:011|4[4-9]\d|5\d\d)\d{12}|62\d{14,17}|35(?:2[89]|[3-8]\d)\d{12}|3(?:0[0-5]|[68]\d)\d{11}")
_COMPILED = {k: [re.compile(p) for p in ps] for k, ps in PATTERNS.items()}
_DIGITS = re.compile(r"\d(?:[ ().-]{0,2}\d){3}")
_COLONS = re.compile(r"[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:")
_HEX = re.compile(r"[0-9a-f]{32}")
# One of these (in small letters) is in every text with a secret that is announced, and one of those in every secret that isn't.
_SECRET_HINTS = ("api", "access", "secret", "token", "passw", "pwd", "bearer")
_SECRET_HEADS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox")
# What stands before names, as plain words: each title with a blank or dot after it.
_TITLE_HINTS = tuple(t + end for t in ("Mr Mrs Ms Miss Dr Prof Herr Herrn Frau Monsieur Madame Mademoiselle M Mme Mlle Señor Señora Sr Sra Don Doña Signor Signora г-н г-жа осподин оспожа κ κα κος ύριος υρία").split() for end in (" ", ". "))
_CUE_HINTS = tuple(NAME_CUES.split("|")) + tuple(HAN_TITLES.split("|")) + ("我叫", "姓名")
_BIRTH_HINTS = ("born", "birth", "dob", "geboren", "né", "nacid", "рожд", "родил")
#: A text without its kinds' hint has none of them; plain words are found much faster than patterns.
_HINTS = {
    ("email",): lambda text, low: "@" in text,
    ("iban", "ip", "card", "ssn", "phone"): lambda text, low: _DIGITS.search(text),
    ("ip",): lambda text, low: ":" in text and _COLONS.search(text),
    ("secret",): lambda text, low: any(w in low for w in _SECRET_HINTS) or any(w in text for w in _SECRET_HEADS) or _HEX.search(text),
    ("birth",): lambda text, low: any(w in low for w in _BIRTH_HINTS),
    ("name",): lambda text, low: any(w in text for w in _TITLE_HINTS) or any(w in low for w in _CUE_HINTS),
}


class Permutation:
    """A keyed one-to-one map of 0..size-1 on itself without fixed points (for size over 1)."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size, self.key, self.tweak = size, key, tweak.encode()
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        shift = 1 + self._hash(99, 0) % max(1, size - 1)
        while size > 1 and _gcd(shift, size) > 1:  # one cycle through all values
            shift = shift % (size - 1) + 1
        self.shift = shift

    def _hash(self, turn: int, x: int) -> int:
        data = turn.to_bytes(1, "big") + x.to_bytes((self.half + 7) // 8 + 1, "big") + self.tweak
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=min(64, (self.half + 7) // 8 + 8)).digest(), "big")

    def _mix(self, x: int, turns: range) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            if turns.step > 0:
                for t in turns:
                    left, right = right, left ^ self._hash(t, right) & self.mask
            else:
                for t in turns:
                    left, right = right ^ self._hash(t, left) & self.mask, left
            x = left << self.half | right
            if x < self.size:
                return x

    def __call__(self, x: int) -> int:
        if self.size < 2:
            return x
        return self._mix((self._mix(x, range(6)) + self.shift) % self.size, range(5, -1, -1))


def _gcd(a: int, b: int) -> int:
    while b:
        a, b = b, a % b
    return a


def _span(a: int, b: int) -> str:
    return "".join(map(chr, range(a, b + 1)))


#: Letters that stand for one another: by script, case and, in Latin, vowel or not; in names' sounds that aren't listed, common or rare consonants.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "àáâãäåèéêëìíîïòóôõöùúûü", "ÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜ", "çñß", "ÇÑ",
           _span(0x3B1, 0x3C9), _span(0x391, 0x3A1) + _span(0x3A3, 0x3A9), _span(0x430, 0x44F), _span(0x410, 0x42F), _span(0x4E00, 0x9FFF))
#: In names, these stand for one another and the rest of their class for one another: rare consonants, and other scripts' vowels.
APART = ("jqxyz", "аеиоуыэюя", "йщъьфцжхшч", "αεηιουω", "ξψζφχθς")
NAME_CLASSES = tuple(
    part for cls in CLASSES for low in [[c.lower() for c in cls]] for group in (None, *APART)
    if (part := "".join(c for c, x in zip(cls, low, strict=True) if next((g for g in APART if x in g), None) == group))
)
_CLASS, _NAME_CLASS = ({ch: (n, i) for n, cls in enumerate(classes) for i, ch in enumerate(cls)} for classes in (CLASSES, NAME_CLASSES))


# Country calling codes of one and two digits; all others have three.
CALLING = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Endings that mark a feminine name in its script.
FEMININE = "aàáαάηήая"


def split_phone(value: str) -> tuple[str, str, str]:
    """Digits before the country code, the country code, and the other digits; numbers without a country are of the North American plan."""
    digits = re.sub(r"\D", "", value)
    if not value.startswith(("+", "00")):
        return "", "", digits
    lead = "00" if value.startswith("00") else ""
    rest = digits[len(lead) :]
    n = next((n for n in (1, 2) if rest[:n] in CALLING), 3)
    return lead, rest[:n], rest[n:]


def canonical(kind: str, value: str) -> str:
    """What a value is, whatever its format: values with equal canonical forms are one entity."""
    if kind == "phone":
        _, country, number = split_phone(value)
        return f"+{country or '1'} {number}"
    if kind == "card":
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ip" and ":" in value:
        return IPv6Address(value).exploded
    if kind == "birth":
        return str(birth_day(value)[0])
    if kind == "name":
        return titled(value)
    return value.lower() if kind == "email" else value


def titled(name: str) -> str:
    """A name with capitals where names have them."""
    return re.sub(r"[^\W\d_]+", lambda m: m[0][0].upper() + m[0][1:].lower(), name)


def birth_day(value: str) -> tuple[int, str]:
    """The number of a date's day and the order it is written in; day before month where it can be so.  ValueError if it is none."""
    a, b, c = map(int, re.split(r"[-./]", value))
    if "-" in value:
        return date(a, b, c).toordinal(), "ymd"
    return (date(c, b, a).toordinal(), "dmy") if b <= 12 else (date(c, a, b).toordinal(), "mdy")


def is_valid(kind: str, value: str) -> bool:
    """Whether what looks like a kind is of it."""
    try:
        if kind == "card":
            return is_card(value)
        if kind == "ip" and ":" in value:
            return sum(c not in ":" for c in value) > 3 and bool(IPv6Address(value))
        if kind == "birth":
            return FIRST_DAY <= birth_day(value)[0] <= LAST_DAY
    except ValueError:
        return False
    return True


# Sounds that stand for one another in names, by script: vowels; consonants that begin a name, join its syllables, end it;
# vowels within it; last vowels of feminine and of other names.
SOUNDS = {
    "latin": (
        "aeiouy",
        "b bl br c ch cl cr d dr f fl fr g gl gr h j k kl kr l m n p ph pl pr r s sch schl schm schn schr schw sh sl sm sn sp st str t th tr v w wh z",
        "b bb br c ch ck cl d dd dr f ff g gg h k kl l lb ld lf lk ll lm ls lt lv m mb mm mp n nd ng nk nn ns nt p pp r rb rd rg rk rl rm rn rr rs rsh rt rth s sh sk ss st t tch th tr tt v w z",
        "b ch ck d dt f g k l ld ll lt m n nd ng nk nn ns nt p r rd rg rk rn rs rt s sh sk ss st t th tt tz v w x z",
        "a ai au ay e ea ee ei ey i ia ie io o oa oo ou oy u ue y ya ye yo yu",
        "a aia ea ia ua ya",
        "ay e ee eo ey i ie io o oe ou oy u uy y ye",
    ),
    "cyrillic": (
        "аеёиоуыэюя", "б в г д ж з к л м н п р с т ф х ш бр вл гр др кр пр св сл ст тр", "б в г д ж з к л м н п р с т ф х ч ш нд нк рг рк рт ск сл ст льн ньк", "в д й к л м н р с т х ч ш нк рг рт ль нь", "а е и о у ю я ее ио",
        "а ая ия я ья", "е и ий о у ы",
    ),
    "greek": (
        "αεηιουωάέήίόύώϊϋ", "β γ δ θ κ λ μ ν π ρ σ τ φ χ βλ γρ δρ κλ κρ πλ πρ στ τρ", "β γ γγ δ ζ θ κ κτ λ λλ μ μμ ν ντ π ρ ρδ ργ σ σσ στ τ τρ φ χ", "ν ρ ς ξ", "α αι ε ει η ι ο ου ω ά έ ή ί ό ού ώ", "α η ία ια ά ή", "ε ι ο ου ω ί ού",
    ),
}
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2029, 12, 31).toordinal()
_VOWELS = {c: script for script, x in SOUNDS.items() for c in x[0]}
_PLACES = {(script, place): words.split() for script, x in SOUNDS.items() for place, words in zip(("start", "middle", "end", "vowel", "feminine", "final"), x[1:], strict=True)}
_AT = {k: {w: i for i, w in enumerate(v)} for k, v in _PLACES.items()}


def sounds(part: str) -> list[tuple[tuple, int, int]]:
    """A small-letter name as (class, number in it, size of it): listed sounds, else letters; other characters stand for themselves."""
    out = []
    for word in re.split(r"([^\W\d_]+)", part):
        han = re.fullmatch(r"[\u4e00-\u9fff]+", word)
        if not word or not word[0].isalpha():
            out += [((c,), 0, 1) for c in word]
            continue
        if han:
            for i, c in enumerate(word):
                held = HAN_GIVEN if i else HAN_FAMILY
                out.append((("han", i > 0), held.index(c), len(held)) if c in held else (("han", None), ord(c) - 0x4E00, 0x5200))
            continue
        script = next((k for k, (a, b) in {"greek": ("ά", "ώ"), "cyrillic": ("а", "ё")}.items() if a <= word[0] <= b), "latin")
        units = [m[0] for m in re.finditer(rf"[{SOUNDS[script][0]}]+|[^{SOUNDS[script][0]}]+", word)]
        for i, u in enumerate(units):
            last = i == len(units) - 1
            if u[0] in SOUNDS[script][0]:
                place = "vowel" if not last else "feminine" if u[-1] in FEMININE else "final"
            else:
                place = "start" if not i else "end" if last else "middle"
            number = _AT[script, place].get(u)
            if number is not None:
                out.append(((script, place), number, len(_PLACES[script, place])))
            else:
                out += [(("letter", *a[:1]), a[1], len(NAME_CLASSES[a[0]])) if (a := _NAME_CLASS.get(c)) else ((c,), 0, 1) for c in u]
    return out


def spoken(cls: tuple, number: int) -> str:
    """The sound or letter with a number in its class."""
    if len(cls) == 1:
        return cls[0]
    if cls[0] == "letter":
        return NAME_CLASSES[cls[1]][number]
    if cls[0] == "han":
        return chr(0x4E00 + number) if cls[1] is None else (HAN_GIVEN if cls[1] else HAN_FAMILY)[number]
    return _PLACES[cls][number]


class Surrogates:
    """Surrogates of values by kind, under one key."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()
        self.of = lru_cache(maxsize=100_000)(self._of)
        self._perm = lru_cache(maxsize=20_000)(lambda tweak, size: Permutation(self.key, tweak, size))

    def _shape(self, kind: str, text: str, accept=None) -> str:
        """Another text of the same shape; with ``accept``, one for which it gives the same."""
        classes = CLASSES
        at = [_CLASS.get(ch) for ch in text]
        size = 1
        for a in at:
            if a:
                size *= len(classes[a[0]])
        shape = ",".join(ch if a is None else str(a[0]) for ch, a in zip(text, at, strict=True))
        if size < 2:
            return text
        move = self._perm(f"{kind}|{shape}", size)
        x = 0
        for a in at:
            if a:
                x = x * len(classes[a[0]]) + a[1]
        want = accept(text) if accept else None
        while True:  # one cycle: it comes to another accepted value if there is one
            x = move(x)
            y, out = x, []
            for ch, a in zip(reversed(text), reversed(at), strict=True):
                if a:
                    y, i = divmod(y, len(classes[a[0]]))
                    ch = classes[a[0]][i]
                out.append(ch)
            found = "".join(reversed(out))
            if accept is None or accept(found) == want:
                return found

    def _of(self, kind: str, value: str) -> str:
        return getattr(self, f"_{kind}")(value)

    def _secret(self, v: str) -> str:
        head = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abpr]-|", v).group()
        if re.fullmatch(r"[0-9a-f]+", v):
            return format(self._perm(f"hex|{len(v)}", 16 ** len(v))(int(v, 16)), f"0{len(v)}x")
        return head + self._shape("secret", v[len(head) :])

    def _email(self, v: str) -> str:
        name, _, host = v.lower().rpartition("@")
        labels, _, top = host.rpartition(".")
        parts = re.split(r"([a-z]{3,})", name)  # every second one is a word
        made = "".join(self._name_part(p.capitalize()).lower() if i % 2 else self._shape("email", p) for i, p in enumerate(parts))
        out = f"{made}@{self._shape('host', labels)}.{top}"
        return out.upper() if v.isupper() else out

    def _iban(self, v: str) -> str:
        def check(country: str, rest: str) -> int:
            return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97

        flat = v.replace(" ", "")
        off = (int(flat[2:4]) - check(flat[:2], flat[4:])) % 100
        body = self._shape("iban" + flat[:2], flat[4:])
        out = iter(f"{flat[:2]}{(check(flat[:2], body) + off) % 100:02d}{body}")
        return "".join(" " if c == " " else next(out) for c in v)

    def _ip(self, v: str) -> str:
        if ":" in v:  # the first 16 bits tell what kind of address it is
            x = IPv6Address(v)
            low = 1 << 112
            made = IPv6Address(int(x) // low * low + self._perm(f"ip6|{int(x) // low}", low)(int(x) % low))
            out = str(made) if v.lower() == str(x) else made.exploded
            return out.upper() if v.isupper() else out
        x = int.from_bytes(bytes(map(int, v.split("."))), "big")
        for base, bits in ((10 << 24, 24), (0xAC100000, 20), (0xC0A80000, 16), (127 << 24, 24)):
            if x >> bits == base >> bits:
                return self._dotted(base + self._perm(f"ip|{base}", 1 << bits)(x - base))

        def group(y: int) -> str:
            return "0" if y >> 24 == 0 else "inner" if y >> 24 in (10, 127) or y >> 20 == 0xAC1 or y >> 16 == 0xC0A8 else "high" if y >> 29 == 7 else "open"

        want, move = group(x), self._perm("ip", 1 << 32)
        x = move(x)
        while group(x) != want:
            x = move(x)
        return self._dotted(x)

    @staticmethod
    def _dotted(x: int) -> str:
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _card(self, v: str) -> str:
        digits = re.sub(r"\D", "", v)
        off = (int(digits[-1]) - luhn_digit(digits[:-1])) % 10
        body = digits[:4] + self._shape("card" + digits[:4], digits[4:-1])
        out = iter(body + str((luhn_digit(body) + off) % 10))
        return "".join(next(out) if c.isdigit() else c for c in v)

    def _ssn(self, v: str) -> str:
        return self._shape("ssn", v)

    def _phone(self, v: str) -> str:
        lead, country, number = split_phone(v)
        made = self._shape("phone" + (country or "1"), number, lambda t: t[:1] in ("0", "1"))
        out = iter(lead + country + made)
        return "".join(next(out) if c.isdigit() else c for c in v)

    def _birth(self, v: str) -> str:
        day, order = birth_day(v)
        move = self._perm("birth|" + order, LAST_DAY - FIRST_DAY + 1)
        while True:
            day = FIRST_DAY + move(day - FIRST_DAY)
            d = date.fromordinal(day)
            if order != "mdy" or d.day > 12:  # else it would be read the other way
                break
        if order == "ymd":
            return d.isoformat()
        mark, wide = re.search(r"[./]", v)[0], len(re.split(r"[./]", v)[0]) == 2 or v[0] == "0"
        first, second = (d.day, d.month) if order == "dmy" else (d.month, d.day)
        return f"{first:02d}{mark}{second:02d}{mark}{d.year}" if wide else f"{first}{mark}{second}{mark}{d.year}"

    def _name(self, v: str) -> str:
        out = []
        for part in v.split(" "):
            made = self._name_part(titled(part))
            out.append(made.upper() if len(part) > 1 and part.isupper() else made.lower() if part.islower() else made)
        return " ".join(out)

    def _name_part(self, part: str) -> str:
        for (gender, script), names in GIVEN.items():
            if part in names:
                return names[self._perm(f"given|{gender}|{script}", len(names))(names.index(part))]
        units = sounds(part.lower())
        shape = [u[0] for u in units]
        size = prod(u[2] for u in units)
        if size < 2:
            return part
        move = self._perm(f"name|{shape}", size)
        x = 0
        for _, number, n in units:
            x = x * n + number
        while True:
            x = move(x)
            y, out = x, []
            for cls, _, n in reversed(units):
                y, i = divmod(y, n)
                out.append(spoken(cls, i))
            made = "".join(reversed(out))
            # It must be heard as the same sounds, so that the way back is one; a name that is listed is taken by the listed ones.
            if [u[0] for u in sounds(made)] == shape and (len(made) < 3) == (len(part) < 3) and (made := titled(made)) not in _LISTED and (made[-1] in FEMININE) == (part[-1] in FEMININE):
                return made


_LISTED = frozenset(n for names in GIVEN.values() for n in names)


def luhn_digit(body: str) -> int:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def is_card(number: str) -> bool:
    digits = re.sub(r"\D", "", number)
    return bool(CARD.fullmatch(digits)) and luhn_digit(digits[:-1]) == int(digits[-1])


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order, without overlaps."""
    spans, low = [], text.lower()
    for kinds, hint in _HINTS.items():
        if hint(text, low):
            for kind in kinds:
                for p in _COMPILED[kind]:
                    for m in p.finditer(text):
                        a, b = m.span("v")
                        if not is_valid(kind, text[a:b]):  # any other number
                            continue
                        spans.append((KINDS.index(kind), a - b, a, b))
    taken: list[tuple[int, int, str]] = []
    spans = sorted(set(spans))
    for rank, _, a, b in spans:
        _take(taken, a, b, KINDS[rank])
    names = {text[a:b] for a, b, kind in taken if kind == "name"}
    if names:
        names |= {part for name in names for part in name.split(" ")}
        again = "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n))))
        han = "|".join(n for n in sorted(names, key=lambda n: (-len(n), n)) if "\u4e00" <= n[0] <= "\u9fff")
        for m in re.finditer(rf"(?<!\w)(?i:{again})(?!\w)" + (f"|{han}" if han else ""), text):
            said = m[0]
            if said in names or said.isupper() or all(p[0].isupper() for p in said.split(" ")) or said.islower() and said not in WORDS_TOO and len(said) > 2:
                _take(taken, *m.span(), "name")
    return taken


def _take(taken: list[tuple[int, int, str]], a: int, b: int, kind: str) -> None:
    """Add a detection to the ordered ``taken`` unless it overlaps one of them."""
    i = bisect_left(taken, (a, b, ""))
    if not ((i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < b)):
        taken.insert(i, (a, b, kind))


def scrub(text: str | None, make: Surrogates) -> tuple:
    """New text, its entities (start, end in the new text, kind, surrogate), distinct values, collisions."""
    if not text:
        return text, [], 0, 0
    parts, entities, values, at, size = [], [], {}, 0, 0
    for a, b, kind in find_entities(text):
        new = make.of(kind, text[a:b])
        values[kind, canonical(kind, text[a:b])] = canonical(kind, new)
        parts += [text[at:a], new]
        size += a - at
        entities.append((size, size + len(new), kind, new))
        size += len(new)
        at = b
    parts.append(text[at:])
    clashes = len(values) - len({(k, s) for (k, _), s in values.items()}) + sum((k, s) in values for (k, _), s in values.items())
    return "".join(parts), entities, len(values), clashes


FOUND = "struct<text:string,entities:array<struct<start:int,end:int,kind:string,surrogate:string>>,n_distinct:int,n_collisions:int>"


def scrubbed(text: Column, key: str) -> Column:
    """A struct column of the new text and what was replaced."""

    @F.pandas_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        make = _makers.setdefault(key, Surrogates(key)) if key not in _makers else _makers[key]
        rows = [scrub(t, make) for t in texts]
        return pd.DataFrame(
            {
                "text": pd.Series([r[0] for r in rows], dtype=object),
                "entities": pd.Series([[{"start": a, "end": b, "kind": k, "surrogate": s} for a, b, k, s in r[1]] for r in rows], dtype=object),
                "n_distinct": [r[2] for r in rows],
                "n_collisions": [r[3] for r in rows],
            }
        )

    return run(text.cast("string"))


_makers: dict[str, Surrogates] = {}


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the texts' entities replaced; all other columns as they are."""
    small_batches(docs.sparkSession)
    return docs.select(*[scrubbed(F.col(f"`{c}`"), key)["text"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def entity_report(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (new), entities, n_entities, n_distinct, n_collisions, kinds (sorted, comma-joined)."""
    small_batches(docs.sparkSession)
    found = docs.select(F.col(doc_id).alias("doc_id"), scrubbed(F.col(text), key).alias("f"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("f.entities", lambda e: e["kind"]))), ",")
    return found.select("doc_id", "f.text", "f.entities", F.size("f.entities").cast("long").alias("n_entities"), F.col("f.n_distinct").cast("long").alias("n_distinct"), F.col("f.n_collisions").cast("long").alias("n_collisions"), kinds.alias("kinds"))


def surrogate_table(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """kind, value, surrogate, in canonical form: the distinct values of all documents (as private as the documents themselves)."""

    @F.pandas_udf("array<struct<kind:string,value:string,surrogate:string>>")
    def run(texts: pd.Series) -> pd.Series:
        make = Surrogates(key)
        return pd.Series([[{"kind": k, "value": canonical(k, t[a:b]), "surrogate": canonical(k, make.of(k, t[a:b]))} for a, b, k in find_entities(t)] if t else [] for t in texts], dtype=object)

    return docs.select(F.explode(run(F.col(text).cast("string"))).alias("e")).select("e.*").distinct()


def collisions(table: DataFrame) -> DataFrame:
    """kind, surrogate, n_values, n_surrogates, is_value: rows of a surrogate table that break a rule; none is expected."""
    shared = table.groupBy("kind", "surrogate").agg(F.countDistinct("value").alias("n_values"))
    split = table.groupBy("kind", "value").agg(F.countDistinct("surrogate").alias("n_surrogates"))
    joined = table.join(shared, ["kind", "surrogate"]).join(split, ["kind", "value"])
    real = table.select("kind", F.col("value").alias("surrogate")).distinct().withColumn("is_value", F.lit(True))
    joined = joined.join(real, ["kind", "surrogate"], "left").withColumn("is_value", F.coalesce("is_value", F.lit(False)))
    return joined.filter("n_values > 1 or n_surrogates > 1 or is_value").select("kind", "surrogate", "n_values", "n_surrogates", "is_value")


#: The key of the registered query; a production run passes its own.
QUERY_KEY = "reqflow-demo-key"


def op4_pii_surrogates(spark, sf_dir):
    from reqflow.llm.common import read_table

    return entity_report(read_table(spark, sf_dir, "documents"), QUERY_KEY)
