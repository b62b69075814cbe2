"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Candidates come from loose patterns. Three kinds of labelers vote on each: form (strict patterns and checksums), gazetteer (given
names, country prefixes) and context (words before the candidate). No labels are needed: EM on the counts of vote patterns over
the whole table estimates, for each kind, how far each labeler can be trusted, and its posteriors train a logistic classifier on votes and shape.
Spans of the base kinds are exact rules and always stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, whole_text

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "name"]
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Looser forms, each proposing candidates of one kind.
LOOSE = {
    "email": re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._-]{1,40} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{2,40} ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,10}\b"),
    "phone": re.compile(r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ssn": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Sr|Sra|Mme|Prof)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?\b"),
}
# Words that stand before personal data of a kind, words that stand before other numbers, and given names.
CONTEXT = {
    "email": ["email", "e-mail", "mail", "contact", "write"], "ip": ["ip", "host", "address", "server"], "card": ["card", "visa", "credit", "payment", "karte", "tarjeta", "carte"],
    "phone": ["phone", "tel", "call", "mobile", "fax", "telefon"], "iban": ["iban", "account", "bank", "konto", "cuenta"], "ssn": ["ssn", "social", "security"], "name": ["dear", "name", "signed", "regards", "by"],
}
OTHER_CONTEXT = ["version", "isbn", "order", "invoice", "serial", "part", "page", "id", "sku", "release", "model"]
GIVEN_NAMES = frozenset(
    "ahmed aisha alice amanda amelia ana andrea andrew angela anna anne antonio arthur barbara ben bruno carlos carmen carol charles charlotte chen chloe christian christine claire "
    "claudia daniel david diana diego dmitri elena elizabeth emily emma eric erik eva fatima felix fernando florian francesca francois frank gabriel george giulia grace hannah hans "
    "harry heinz helen henry hugo ingrid irene isabel ivan jack jacob james jan jane javier jean jennifer jessica joan johann john jorge jose joseph juan julia julie kai karen karl "
    "katarina kate kevin klaus laura lea leon linda lisa louis louise lucas lucia luis luke manuel marco margaret maria marie mario mark martin mary matthew max mia michael miguel "
    "mohammed monica nadia natalie nicolas nina oliver olivia omar pablo patricia paul pedro peter petra philip pierre priya rachel ravi rebecca ricardo richard robert rosa ruth "
    "samuel sandra sara sarah sebastian simon sofia sophie stefan stephen susan teresa thomas tim tom ursula victor victoria wei william yuki yusuf".split()
)
DIAL_PREFIXES = ("+1", "+7", "+20", "+27", "+30", "+31", "+32", "+33", "+34", "+39", "+40", "+41", "+43", "+44", "+45", "+46", "+47", "+48", "+49", "+52", "+54", "+55", "+61", "+64", "+81", "+82", "+86", "+90", "+91", "+351", "+353", "+358", "+420", "+971", "+972")
EVIDENCE = ["form", "gazetteer", "context"]
#: Votes are 0 (abstains), 1 (for) and 2 (against); three labelers for each kind bound the patterns at 27 a kind.
ABSTAIN, FOR, AGAINST = 0, 1, 2
#: Candidates that the span classifier is fitted on, those with the smallest hashes of candidate and context.
SAMPLE = 20_000
#: What the reliabilities over all kinds weigh against each candidate of a kind.
PRIOR_WEIGHT = 1.0


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_holds(kind: str, found: str) -> bool:
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


_DOTTED = re.compile(r"[0-9]\.[0-9]")


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")


def base_matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """The places of BASE[kind] in the text, leftmost and not overlapping, in time linear in the text.

    An address is looked for from its @ to the left, and dotted numbers are taken four at a time from a whole run of them: the
    patterns themselves start anew at each character of a long run.
    """
    if kind == "email":
        at, last = text.find("@"), 0
        while at >= 0:
            domain, start = _DOMAIN.match(text, at), at
            if domain:
                while start > last and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    last = domain.end()
                    yield start, last
            at = text.find("@", max(at + 1, last))
    elif kind == "ip":
        if _DOTTED.search(text):
            for run in _NUMBERS.finditer(text):
                if run.group(0).count(".") >= 3:
                    ends = [m.span() for m in re.finditer("[0-9]+", run.group(0))]
                    for k in range(0, len(ends) - 3, 4):
                        yield run.start() + ends[k][0], run.start() + ends[k + 3][1]
    elif kind != "phone" or "+" in text:
        for m in BASE[kind].finditer(text):
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), leftmost and not overlapping for each kind; matches that fail their check are dropped."""
    found = [(k, a, b) for k, kind in enumerate(BASE) for a, b in base_matches(kind, text) if kind != "card" or b - a >= 16]
    return [(k, a, b) for k, a, b in found if base_holds(KINDS[k], text[a:b])]


_NEEDS = {"email": ("at",), "phone": None, "iban": None, "ssn": ("-",), "name": ("r", "M", "F", "D", "P")}
_TAIL = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_RUN = re.compile(r"[0-9]{3}")


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base): base spans, and loose ones that overlap none of them nor each other."""
    spans = [(*s, True) for s in base_spans(text)]
    loose = []
    numbers = _RUN.search(text) is not None
    for kind, pattern in LOOSE.items():
        if kind in ("phone", "ssn", "iban") and not numbers or kind == "email" and not ("dot" in text and "at" in text):
            continue
        loose += [(KINDS.index(kind), *m.span()) for m in pattern.finditer(text)]
    if loose:
        taken = bytearray(len(text))
        for _, a, b, _ in spans:
            taken[a:b] = b"\1" * (b - a)
        for kind, a, b in loose:
            if taken.find(1, a, b) < 0:
                spans.append((kind, a, b, False))
                taken[a:b] = b"\1" * (b - a)
    return sorted(spans)


def _iban(found: str) -> bool:
    raw = found.replace(" ", "")
    return 15 <= len(raw) <= 34 and int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, int, int]:
    """What form, gazetteer and context say about a candidate."""
    name, found = KINDS[kind], text[start:end]
    digits = re.sub(r"[^0-9]", "", found)
    if name in BASE and BASE[name].fullmatch(found):
        form = FOR if base_holds(name, found) else AGAINST
    elif name == "iban":
        form = FOR if _iban(found) else AGAINST
    elif name == "ssn":
        form = AGAINST if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else FOR
    else:
        form = FOR if name == "phone" and 8 <= len(digits) <= 15 else ABSTAIN
    parts = {p.lower() for p in re.findall(r"[A-Za-z]+", found)}
    gazetteer = FOR if parts & GIVEN_NAMES or name == "phone" and found.startswith(DIAL_PREFIXES) or name == "iban" and found[:2] in ("DE", "FR", "ES", "GB", "NL", "IT", "AT", "CH", "BE") else AGAINST if name == "iban" else ABSTAIN
    before = {w.lower() for w in _TAIL.findall(text[max(0, start - 40) : start])}
    context = FOR if before & set(CONTEXT[name]) else AGAINST if before & set(OTHER_CONTEXT) else ABSTAIN
    return form, gazetteer, context


def shape(found: str) -> tuple[float, float, float]:
    n = max(len(found), 1)
    return len(found) / 40, sum(c.isdigit() for c in found) / n, len(set(found)) / n


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 50, prior: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Prevalence and reliabilities P(vote | class) for (class, labeler, vote), from counts of vote patterns.

    A Dirichlet prior (class, labeler, vote), by default ten counts that a labeler is more often right than wrong and seldom speaks
    against personal data, breaks the symmetry of the two classes.
    """
    patterns, n = np.array(list(counts), dtype=int).reshape(-1, len(EVIDENCE)), np.array(list(counts.values()), dtype=float)
    if prior is None:
        prior = np.empty((2, len(EVIDENCE), 3))
        prior[1], prior[0] = (5.0, 4.7, 0.3), (5.0, 1.0, 4.0)
    table, share = prior / prior.sum(axis=2, keepdims=True), 0.5
    for _ in range(rounds):
        p = posterior(patterns, share, table)
        share = (n @ p + 1) / (n.sum() + 2)
        for c, weight in ((0, n * (1 - p)), (1, n * p)):
            for k in range(len(EVIDENCE)):
                table[c, k] = prior[c, k] + np.bincount(patterns[:, k], weights=weight, minlength=3)
        table = table / table.sum(axis=2, keepdims=True)
    return float(share), table


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """P(personal data | votes), labelers taken as independent."""
    logs = [np.log(s) + sum(np.log(table[c, k, patterns[:, k]]) for k in range(len(EVIDENCE))) for c, s in ((0, 1 - share), (1, share))]
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def _inputs(v: tuple[int, int, int], kind: int, base: bool, found: str) -> list[float]:
    return [1.0, *(float(x == FOR) for x in v), *(float(x == AGAINST) for x in v), *shape(found), float(base), *(float(kind == k) for k in range(len(KINDS)))]


@dataclass
class Model:
    """Prevalence and reliabilities of each kind, and the classifier's weights."""

    shares: list[float]
    tables: list[np.ndarray]
    beta: np.ndarray

    def accepts(self, text: str, kind: int, start: int, end: int) -> bool:
        x = np.array(_inputs(votes(text, kind, start, end), kind, False, text[start:end]))
        return bool(x @ self.beta > 0)


def prior_model() -> Model:
    return Model([0.5] * len(KINDS), [expectation_maximisation({})[1]] * len(KINDS), np.zeros(len(_inputs((0, 0, 0), 0, False, ""))))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """EM over the vote patterns of all candidates, over all kinds and then for each kind, then the classifier on at most sample candidates.

    Each task sends its pattern counts (at most 27 for each kind) and the sample candidates with the smallest hashes of their
    surroundings, in the order by which all tasks' rows are cut to the sample; both are bounded whatever the table, and how it is
    split makes no difference. A table without candidates gives the prior. Nulls count as empty texts.
    """

    def voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        seen, kept = Counter(), []
        for batch in batches:
            for text in batch["text"]:
                for kind, a, b, base in candidates(text):
                    v = votes(text, kind, a, b)
                    seen[kind, *v] += 1
                    kept.append((zlib.crc32(text[max(0, a - 40) : b].encode()), [kind, *v], [float(x) for x in _inputs(v, kind, base, text[a:b])]))
                    if len(kept) >= 2 * sample:
                        kept = sorted(kept)[:sample]
        if not seen:
            return
        kept = sorted(kept)[:sample]
        yield pd.DataFrame({"votes": [list(v) for v in seen], "n": list(seen.values()), "x": [None] * len(seen), "key": [0] * len(seen)})
        yield pd.DataFrame({"votes": [v for _, v, _ in kept], "n": [0] * len(kept), "x": [x for _, _, x in kept], "key": [k for k, _, _ in kept]})

    rows = materialize(docs.select(whole_text().alias("text")).mapInPandas(voted, "votes array<int>, n long, x array<double>, key long"))
    counted = rows.where("x is null").groupBy("votes").agg(F.sum("n").alias("n"))
    drawn = rows.where("x is not null").orderBy("key", "votes", "x").limit(sample)
    both = counted.select("votes", "n", F.lit(None).cast("array<double>").alias("x")).unionByName(drawn.select("votes", "n", "x")).toPandas()
    discard(rows)
    model = prior_model()
    patterns = [tuple(int(x) for x in v) for v in both["votes"]]
    pooled: Counter = Counter()
    for v, n in zip(patterns, both["n"], strict=True):
        pooled[v[1:]] += int(n)
    _, shared = expectation_maximisation({v: n for v, n in pooled.items() if n})
    for kind in range(len(KINDS)):
        own = {v[1:]: int(n) for v, n in zip(patterns, both["n"], strict=True) if n > 0 and v[0] == kind}
        # the form of a kind's candidates mostly says the same of all, and one labeler alone can't tell its own errors from other
        # numbers; so a kind starts from the reliabilities over all kinds, which weigh as much as its candidates
        model.shares[kind], model.tables[kind] = expectation_maximisation(own, prior=shared * (10.0 + PRIOR_WEIGHT * sum(own.values())))
    chosen = [(v, list(x)) for v, n, x in zip(patterns, both["n"], both["x"], strict=True) if n == 0]
    # the model's own view of every pattern keeps kinds that the sample lacks from being decided by nothing
    every = [(a, b, c) for a in range(3) for b in range(3) for c in range(3)]
    chosen = sorted(chosen) + [((k, *v), _inputs(v, k, False, "")) for k in range(len(KINDS)) for v in every]
    x, target = np.array([x for _, x in chosen], dtype=float), np.empty(len(chosen))
    kinds, vote = np.array([v[0] for v, _ in chosen]), np.array([v[1:] for v, _ in chosen])
    for kind in range(len(KINDS)):
        target[kinds == kind] = posterior(vote[kinds == kind], model.shares[kind], model.tables[kind])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ model.beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(len(model.beta)), x.T @ (target - p) - 0.1 * model.beta)
        model.beta = model.beta + step
        if np.abs(step).max() < 1e-6:
            break
    return model


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def pii_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    spans lists kind:start:end in code points, end exclusive, by kind (KINDS' order), then start. Null texts count as empty: counts 0,
    no spans, the digest of the empty string. Repeated rows come out as often as they come in; an empty table gives no
    rows; other columns are not read. Without a model the model is fitted on docs.
    """
    model = model or fit(docs)

    @F.pandas_udf(SCHEMA)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        for texts in batches:
            rows = []
            for text in texts:
                spans = candidates(text)
                base = [s for s in spans if s[3]]
                n = [sum(s[0] == k for s in base) for k in range(4)]
                listed = lambda group: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in group)
                rows.append((*n, sha256(listed(base).encode()).hexdigest(), listed([s for s in spans if s[3] or model.accepts(text, *s[:3])])))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", found(whole_text()).alias("found")).select("doc_id", "found.*")
