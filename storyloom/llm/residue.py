"""Template residue, filler, error messages and calls for scripts, found by labelled exemplars.

Each passage window of a text retrieves the exemplars that share its words through an inverted index; an exemplar counts as
found where a window no longer than itself (with a little slack) holds nearly all of its TF-IDF weight. Filler counts
wherever it stands in a story, messages only where they make up the page. In placeholders the marks tell, not the words: a
text's marks are read as shapes (what opens, what closes, what kind of words stand between), and the exemplars of placeholders
are indexed by their shapes. A placeholder is talked about, not left unfilled, where an exemplar of such talk is found in the
words that lead up to it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict

#: Labelled exemplars (fixed values, extendable by the caller): kind, then the text. Numbers and codes are left out.
EXEMPLARS: list[tuple[str, str]] = [
    ("filler", "Lorem ipsum dolor sit amet consectetur adipiscing elit"),
    ("filler", "sed do eiusmod tempor incididunt ut labore et dolore magna aliqua"),
    ("filler", "Lorem ipsum dolor vestra conde et mirabor silentum quas per novitas sed ordo nil palenta"),
    ("filler", "Dolor amet cursum valdis tempora lorum in fineas nec ultra porro"),
    ("filler", "Quote goes here Quote goes here Name title"),
    ("filler", "Your text goes here Replace this paragraph with words about the outcome"),
    ("filler", "This is placeholder content Editors swap in the approved story ticket"),
    ("filler", "This is placeholder text and will be replaced before publication"),
    ("filler", "Sample copy for layout only body body body body second line of body characters to come"),
    ("filler", "TODO write this section before release"),
    ("filler", "TODO add content here before launch"),
    ("filler", "asdf asdf jkl test test"),
    ("filler", "Texte provisoire numéro à remplacer avant publication"),
    ("filler", "Hier steht Blindtext Zeile bitte vor der Freigabe ersetzen"),
    ("error", "Page not found The address may have changed or the page was taken down Try the search box"),
    ("error", "Page not found The page you requested could not be found"),
    ("error", "Nothing here but dust Let us take you back to the start page"),
    ("error", "Something went wrong Our servers had trouble with this request Please try again in a few minutes"),
    ("error", "Internal error An unexpected condition was met The incident has been logged"),
    ("error", "Internal server error"),
    ("error", "Bad Gateway The upstream service gave no answer in time"),
    ("error", "Service unavailable We are doing some work on the site and will be back shortly"),
    ("error", "Service unavailable back soon"),
    ("error", "Site is under maintenance ticket"),
    ("error", "Access denied You do not have permission to view this resource on this server"),
    ("error", "Sorry you have been blocked Reference"),
    ("error", "Session expired Please sign in again to go on"),
    ("error", "Too many requests Slow down you have sent more requests than we can answer"),
    ("error", "This story has moved The content you asked for is no longer offered in your country"),
    ("error", "This page can't be shown right now Try again later"),
    ("error", "Page introuvable Cette adresse n’existe pas ou plus"),
    ("error", "Seite nicht gefunden Die gewünschte Adresse gibt es nicht oder nicht mehr"),
    ("script", "Please turn on JavaScript in your browser to see this page"),
    ("script", "You need to enable JavaScript to run this app"),
    ("script", "This app cannot run without scripts Enable them and reload"),
    ("script", "Your browser is out of date or blocks scripts the story cannot be shown"),
    ("script", "Checking your browser before we let you in This takes a moment and needs cookies and scripts"),
    ("script", "Just a moment please allow scripts and cookies to go on"),
    ("script", "One more step confirm that you are a person Scripts must be allowed"),
    ("script", "Loading If nothing happens allow scripts for this site"),
    ("script", "Attention required Please enable scripts"),
    ("script", "Bitte aktivieren Sie JavaScript um diesen Inhalt anzuzeigen"),
    ("script", "Veuillez activer JavaScript pour afficher cette page"),
]
EXEMPLARS += [("placeholder", x) for x in (
    "Dear {{ first_name }}", "{% block title %}", "<% story.title %>", "${customer}", "#{customer}", "%%CUSTOMER%%", "@@CUSTOMER@@", "[[customer]]", "[INSERT NAME 2]", "[ADD FIGURE (%)]", "[YOUR TEXT, 2 lines]",
    "[TBD: quote]", "[TODO: result]", "[Customer name]", "__CUSTOMER__", "{customer}", "{0}", "%(customer)s", "%s", "%d", "<customer name here>", "<add result>", "<insert quote>", "<enter name>", "<your text>",
    "<replace this>", "<put figure>", "<fill in>", "<write here>", "<name>", "<company>", "<customer>", "<product>", "<quote>", "XX %", "XXX", "null null", "undefined", "NaN", "TODO: text", "FIXME", "TK TK", "TKTK", "INSERT NAME HERE", "YOUR TEXT HERE",
)]
EXEMPLARS += [("mention", x) for x in (
    "such as", "word", "words", "term", "terms", "mark", "marks", "token", "tokens", "tag", "tags", "variable", "variables", "syntax", "string", "strings", "called", "named", "like", "literal", "placeholder", "placeholders",
    "template", "templates", "mot", "balise", "wort", "marke", "zeichenfolge",
)]
#: How marks are read as shapes: a name and what it looks like. A shape with a group is told apart by the word it catches.
SHAPES = {
    "{{}}": r"\{\{[^{}]{1,60}\}\}", "{%%}": r"\{%[^{}]{1,60}%\}", "<%%>": r"<%[^<>]{1,60}%>", "${}": r"\$\{[^{}]{1,60}\}", "#{}": r"#\{[^{}]{1,60}\}", "%%": r"%%[^%\s]{1,40}%%", "@@": r"@@[^@\s]{1,40}@@",
    "[[]]": r"\[\[[^\[\]]{1,60}\]\]", "[!]": r"\[(?P<order>[A-Z]{3,})\b[^\[\]]{0,60}\]", "[]": r"\[[A-Za-z][\w'’-]*(?: [A-Za-z][\w'’-]*){0,5}\]", "__": r"__[A-Z][A-Z0-9_]*__", "{}": r"(?<![\w{])\{[a-z_]*\d*\}(?!\w)",
    "%()": r"%\([a-z_]+\)[sd]", "%": r"(?<!\S)%(?P<format>[a-z])(?![\w%])", "<.>": r"<[a-z]+(?: [a-z]+){1,5} (?P<last>[a-z]+)>", "<!>": r"<(?P<first>[a-z]+)\b[^<>=]{0,40}>", "XX%": r"\bXX+ ?%", "XX": r"\bXX+\b",
    "twice": r"\b(?P<twice>\w{2,6}) (?P=twice)\b", "caps:": r"\b(?P<caps>[A-Z]{4,}):", "bare": r"\b(?P<bare>undefined|NaN|[A-Z]{4,})\b", "caps here": r"\b(?P<ask>[A-Z]{4,}) [A-Z]+(?: [A-Z]+)? HERE\b",
}
PATTERNS = [(name, re.compile(x)) for name, x in SHAPES.items()]


def shapes_of(text: str) -> list[tuple[str, int, int]]:
    """(shape, from, to) of the marks in a text."""
    return [(f"{name} {m[1]}" if pattern.groups else name, m.start(), m.end()) for name, pattern in PATTERNS for m in pattern.finditer(text)]


WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
HAS_DIGIT = re.compile(r"\d")
#: Share of an exemplar's weight a window must hold, and of the window's weight that must be the exemplar's.
CONTAINED, FOCUSED = 0.8, 0.5
#: Share of a page's words that messages must cover to stand in place of the story; the rest is a name or a reference.
COVERED = 0.5


def words_of(text: str) -> list[str]:
    return [w for w in WORD.findall(text.lower().replace("’", "'")) if not HAS_DIGIT.search(w)]


MESSAGES, FILLER, TALK = frozenset(("error", "script")), frozenset(("filler",)), frozenset(("mention",))
#: Words before a placeholder in which talk about it is looked for.
LEAD = 3


class Index:
    """Inverted index word -> exemplars, with the weights of their words.

    counts: pages holding each exemplar word, and all pages under ''; without counts all words weigh the same."""

    def __init__(self, exemplars: list[tuple[str, str]], counts: dict[str, int] | None = None):
        self.exemplars = [(kind, [] if kind == "placeholder" else words_of(text)) for kind, text in exemplars]
        self.shapes: dict[str, list[int]] = defaultdict(list)  # shape -> exemplars of placeholders
        signs = {r"[{\[<@%#$]", "__"}
        for i, (kind, text) in enumerate(exemplars):
            if kind == "placeholder" and (found := shapes_of(text)):
                shape, start, end = max(found, key=lambda x: x[2] - x[1])  # the longest, the first of equals
                self.shapes[shape].append(i)
                if not re.search(r"[{\[<@%#$]|__", text):
                    signs.add("XX" if shape == "XX" else " HERE" if shape.startswith("caps here") else re.escape(text[start:end]))
        self.shapes = dict(self.shapes)
        self.sign = re.compile("|".join(sorted(signs)))  # what any of these shapes holds: a quick look
        total = (counts or {}).get("", 0)
        self.idf = defaultdict(lambda: math.log(1 + total) + 1) if total else defaultdict(lambda: 1.0)
        for _, words in self.exemplars:
            for w in words:
                self.idf[w] = math.log((1 + total) / (1 + (counts or {}).get(w, 0))) + 1
        self.idf.default_factory = None
        self.unseen = math.log(1 + total) + 1
        self.postings: dict[str, list[int]] = defaultdict(list)
        self.weights: list[dict[str, float]] = []
        for i, (_, words) in enumerate(self.exemplars):
            weight: dict[str, float] = {}
            for w in words:
                weight[w] = self.idf[w]
            self.weights.append(weight)
            for w in weight:
                self.postings[w].append(i)
        self.totals = [sum(w.values()) for w in self.weights]
        self.anchors = {kinds: self._anchors(kinds) for kinds in (MESSAGES, FILLER)}
        self.postings = dict(self.postings)

    def _anchors(self, kinds: frozenset[str]) -> tuple[str, ...]:
        """Words of which a text must hold one to contain any exemplar: of each, the heaviest that the rest can't make up for."""
        out = set()
        for (kind, _), weight, total in zip(self.exemplars, self.weights, self.totals):
            if kind in kinds:
                left = (1 - CONTAINED) * total
                for w in sorted(weight, key=lambda w: (-weight[w], w)):
                    if left < 0:
                        break
                    out.add(w)
                    left -= weight[w]
        return tuple(sorted(out))

    def may_hold(self, lowered: str, kinds: frozenset[str]) -> bool:
        return any(a in lowered for a in self.anchors[kinds])

    def find(self, words: list[str], kinds: frozenset[str]) -> list[tuple[int, int, int]]:
        """(exemplar, from word, to word) of the windows that contain an exemplar of these kinds, the best first, none overlapping."""
        shared: dict[int, float] = defaultdict(float)
        for w in set(words):
            for i in self.postings.get(w, ()):
                shared[i] += self.weights[i][w]
        found = []
        for i, weight in shared.items():
            if self.exemplars[i][0] not in kinds or weight < CONTAINED * self.totals[i]:
                continue
            size = len(self.exemplars[i][1]) + max(2, len(self.exemplars[i][1]) // 5)
            mine = self.weights[i]
            least = CONTAINED * self.totals[i]
            hits = [k for k, w in enumerate(words) if w in mine]
            sums = [0.0]  # a quick look: a window without even this much weight, repeats counted, can't hold enough
            for k in hits:
                sums.append(sums[-1] + mine[words[k]])
            held = []
            for n, start in enumerate(hits):
                if sums[bisect_left(hits, start + size)] - sums[n] < least - 1e-9:
                    continue
                window = words[start : start + size]
                end = start + max(k for k, w in enumerate(window) if w in mine) + 1
                inside = sum(mine[w] for w in set(words[start:end]) if w in mine)
                whole = sum(mine.get(w, self.idf.get(w, self.unseen)) for w in set(words[start:end]))
                if inside >= least and inside >= FOCUSED * whole:
                    held.append((-inside, start, end))
            taken: set[int] = set()
            for _, start, end in sorted(held):
                if taken.isdisjoint(range(start, end)):
                    taken.update(range(start, end))
                    found.append((i, start, end))
        return found


def is_notice_page(texts: list[str], index: Index) -> bool:
    """Whether error messages or calls for scripts stand in place of a story: they cover most words of these lines."""
    if not index.may_hold(" ".join(texts).lower().replace("’", "'"), MESSAGES):
        return False
    words = [w for t in texts for w in words_of(t)]
    if not words:
        return False
    covered: set[int] = set()
    for _, start, end in index.find(words, MESSAGES):
        covered.update(range(start, end))
    return len(covered) >= COVERED * len(words)


def placeholders(text: str, index: Index) -> list[int]:
    """Where placeholders of an indexed shape begin in a text."""
    return sorted({start for shape, start, _ in shapes_of(text) if shape in index.shapes})


def has_placeholder(text: str, index: Index) -> bool:
    """Whether one stands in a text that is not talked about there."""
    return any(not index.find(words_of(text[max(0, start - 60) : start])[-LEAD:], TALK) for start in placeholders(text, index))


def has_filler(text: str, index: Index) -> bool:
    return bool(index.find(words_of(text), FILLER))


def story_residue(texts: list[str], index: Index) -> str | None:
    """'message', 'placeholder' or 'filler' if the story holds it, else None."""
    if is_notice_page(texts, index):
        return "message"
    whole = "\n".join(texts)
    if index.sign.search(whole) and any(has_placeholder(t, index) for t in texts if index.sign.search(t)):
        return "placeholder"
    if index.may_hold(whole.lower(), FILLER) and any(has_filler(t, index) for t in texts if index.may_hold(t.lower(), FILLER)):
        return "filler"
    return None


def error_residue(error: str | None, status: int | None, index: Index) -> bool:
    """Whether an attempt's error text is an unfilled template or, with status 200, repeats a page's message.

    Null and blank texts are none. Python's own '<urlopen error ...>' and the like are ordinary."""
    if not error or not error.strip():
        return False
    text = error.strip()
    if placeholders(re.sub(r"\[errno[^\[\]]*\]", "", text, flags=re.I), index):
        return True
    return status == 200 and is_notice_page([re.sub(r"</?[a-z][a-z0-9]*>", " ", text, flags=re.I)], index)


def vocabulary() -> dict[str, str]:
    """Spellings under which whitespace-split tokens of a text stand for an exemplar word."""
    out = {}
    for kind, text in EXEMPLARS:
        for w in words_of(text) if kind != "placeholder" else ():
            for tail in ("", ".", ",", ":", ";", "…", "?", "!"):
                out[w + tail] = w
    return out
