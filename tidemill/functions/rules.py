"""Detection rules: named patterns over text, their version, and what they find as columns.

Patterns are written to mean the same in Java and RE2: no backreferences, no lookaround, and an
explicit class instead of the word boundary, which the two understand differently beyond ASCII.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A named pattern.  Where the folded text has none of ``needs``, the pattern is not tried.

    A rule of clauses is tried on each clause of the folded text by itself, and finds something in one that
    matches ``pattern`` and not ``unless``: so a negation reaches no further than its clause, and what a
    clause takes back does not count.  Its first group is what it found.
    """

    name: str
    kind: str
    pattern: str
    needs: tuple[str, ...] = ()
    unless: str = ""
    clauses: bool = False


def word(body: str) -> str:
    """``body`` between characters that are no ASCII word characters, or the text's ends."""
    return f"(?:^|[^0-9A-Za-z_])(?:{body})(?:$|[^0-9A-Za-z_])"


def near(first: str, second: str, most: int) -> str:
    """``first``, then ``second`` after ``most`` words at most."""
    return rf"(?:{first})(?:[^a-z0-9]+[a-z0-9'\x{{2019}}]+){{0,{most}}}?[^a-z0-9]+(?:{second})"


def scoped(name: str, kind: str, patterns: tuple[str, ...], needs: tuple[str, ...], unless: tuple[str, ...] = ()) -> Rule:
    """A rule of clauses that any of the patterns meets, as whole words, and none of ``unless`` takes back."""
    return Rule(name, kind, f"(?:^|[^0-9a-z_])({'|'.join(patterns)})(?:$|[^0-9a-z_])", needs, word("|".join(unless)) if unless else "", True)


_SPONSOR = r"sponsor(?:ship|ships|s|ed|ing)?"
_NOT = r"not|never|cannot|can ?not|unable|unwilling|ineligible|neither|nor|(?:ca|wo|do|does|is|are|would|could)n['\x{2019}]?t"
_US = r"(?:u\.?s\.?|united states|american)"
_CITIZEN = r"(?:citizen(?:s|ship)?|nationals?|persons?)"
_MODEL = r"(?:ai|a\.i\.|llms?|gpt|chatbots?|bots?|language models?|automated|machine|robots?)"

#: What tells that a posting bars applicants who need sponsorship.
BARRIER = (
    scoped(
        "no_sponsorship", "barrier", (near("no|without|zero", _SPONSOR, 5),), ("sponsor",),
        (near(_SPONSOR, r"required|needed|necessary|issues?|problems?|concerns?|worr(?:y|ies)|limits?|restrictions?|questions?|fees?|hassle", 2), r"no (?:need|problem|issue|trouble|difficulty|doubt|matter|cost|limit)s?", "no longer (?:need|require)s?", "without (?:hesitation|delay)"),
    ),
    scoped(
        "will_not_sponsor", "barrier", (near(_NOT, _SPONSOR, 5),), ("sponsor",),
        (r"not (?:only|just|hesitate)", "hesitate", near(_NOT, r"require[sd]?|requiring|needs?|needing|needed|affect|prevent|matter|mean|disqualify|worry|let", 4), "unlike", r"not (?:an? )?(?:issue|problem|barrier)", "why not"),
    ),
    scoped(
        "sponsorship_withheld", "barrier",
        (
            near("sponsorship", near(_NOT, "available|offered|provided|possible|supported|considered|given|granted|an option|extended|eligible|part of|something|on offer", 3), 4),
            near("sponsorship", "unavailable|impossible|excluded", 4),
            r"sponsorship(?: available| offered| provided)?[^a-z0-9]{1,4}(?:none|n/a|no)[^a-z0-9]*$",
        ),
        ("sponsor",), (r"not (?:required|needed|necessary|only)",),
    ),
    scoped("must_not_need", "barrier", (near(r"must not|who (?:do|does|will|would) not|who (?:do|does|wo)n['\x{2019}]t|that do not|should not|may not|not now or|nor will", near(r"require|requiring|need|needing", _SPONSOR, 4), 5), near("ineligible|disqualified|rejected", near("require|requiring|need|needing", _SPONSOR, 3), 4)), ("sponsor",)),
    scoped(
        "citizens_only", "barrier",
        (
            near(r"must be|must have|requires?|only|limited to|restricted to|reserved for|have to be|need to be|required to be", f"{_US}[^a-z0-9]+{_CITIZEN}", 3),
            f"{_US}[^a-z0-9]+citizenship(?: is| status is|,| -|:)?(?: [a-z]+)?(?: strictly)? (?:required|mandatory|needed|a must|essential)", f"{_US}[^a-z0-9]+{_CITIZEN}(?: and green card holders| or permanent residents| and permanent residents)? only",
        ),
        ("citizen", "national", "person"), (r"not (?:only|limited|restricted|required|require|necessary|need|have)", r"n['\x{2019}]t (?:need|have|require)", "regardless", "unlike", "no requirement"),
    ),
    scoped(
        "clearance", "barrier",
        (
            near("clearance", "required|mandatory|needed|essential|a must", 2), near(r"must|able to|ability to|required to|need to|have to|eligible to", near("hold|obtain|have|possess|maintain|get|pass|be granted", "clearance", 7), 2),
            near("requires?|requiring", "clearance", 7), near("active|current", near("clearance", "only", 3), 4),
        ),
        ("clearance",), (near(_NOT, r"required?|requiring|needed|needs?|necessary|hold|have", 3), near("no", "clearance", 3), "without", "clearance (?:sales?|rack|items?|center|events?)", "(?:customs|stock|medical|tax|road|ground) clearance"),
    ),
)
#: Text that addresses an automated reader.  It is reported, never followed.
AGENT = (
    scoped(
        "override", "agent",
        (near("ignore|disregard|forget", "(?:instructions?|directions?|rules) above", 3), near("ignore|disregard|forget|override|bypass|discard", near(r"previous|prior|above|preceding|earlier|other|your|system|existing|all", r"instructions?|prompts?|directions?|rules|guidelines|programming|constraints|context", 3), 3),),
        ("instruction", "prompt", "direction", "rules", "guideline", "programming", "constraint", "context"), (r"(?:not|never|n['\x{2019}]t|nobody may|without|cannot) (?:to )?(?:ignor(?:e|ing)|disregard(?:ing)?|forget|bypass(?:ing)?|overrid(?:e|ing))", "(?:applicants|candidates|people|those) who"),
    ),
    scoped("if_model", "agent", (near(r"(?:if|since|as|because|when) you(?: are|['\x{2019}]re)", _MODEL, 3), near(r"if", f"{_MODEL}(?: [a-z]+)? (?:is|are) (?:reading|processing|screening|summari[sz]ing|reviewing|parsing)", 3)), ("you are ", "you're ", "you\u2019re ", "reading", "processing", "screening", "summari", "reviewing", "parsing"), ("interested in", "working on", "excited", "passionate", "familiar", "experienced", "building", "curious", "good at", "into")),
    scoped(
        "agents_must", "agent",
        (f"(?:{_MODEL}|automated|virtual)[^a-z0-9]*(?:agents?|assistants?|models?|tools?|systems?|reviewers?|screeners?|readers?|applicants?)?[^a-z0-9]*(?:must|should|shall|please|are (?:required|instructed|asked|told) to)[^a-z0-9]+(?:not|always|also|include|add|write|mention|say|respond|reply|answer|rate|rank|score|mark|stop|start|apply|put|output|use|skip|ignore|insert|begin|recommend|approve|note|state|reject|leave|identify)",
         near(r"(?:note|message|attention|hello|dear|notice|instructions?)(?: to| for)?[^a-z0-9]+(?:all |any |the )?(?:" + _MODEL + ")", r"agents?|assistants?|models?|tools?|systems?|reviewers?|screeners?|readers?|please|include|rate|rank|recommend|reply|respond|answer|say|write|add|use|stop", 2)),
        ("agent", "assistant", "model", "tool", "system", "review", "screen", "reader", "llm", "bot", "gpt", "ai ", "ai,", "ai:"), (),
    ),
    scoped(
        "system_prompt", "agent", (near("reveal|print|show|output|repeat|disclose|leak|share|send|display|expose|tell|paste|quote|include|summari[sz]e", r"(?:system|hidden|initial|original|secret) (?:prompts?|instructions|message)", 5),),
        ("prompt", "instructions", "message"), ("design|designing|wrote|engineers?|write",),
    ),
)
#: Stand-ins that do occur in the test tables.
STAND_IN = (
    Rule("email", "contact", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", ("@",)),
    Rule("secret_word", "secret", word(r"password|passwd|secret|token|api_?key"), ("passw", "secret", "token", "api")),
    Rule("ipv4", "address", r"(?:^|[^0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?:$|[^0-9.])"),
    Rule("license_word", "license", word(r"licen[sc]ed?|copyright"), ("licen", "copyright")),
)
RULES = BARRIER + AGENT


def version(rules: tuple[Rule, ...] = RULES) -> str:
    """A name for exactly these rules: findings carry it, and other rules force a new reading."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:12]


#: Letters that a pattern without letter case takes for ASCII ones, though lower-casing leaves them.
FOLDED = {"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"}


def _has(low: Column, literals: tuple[str, ...]) -> Column:
    """Whether the folded text has any of the literals: byte searches, far cheaper than a pattern."""
    return reduce(lambda a, b: a | b, (F.contains(low, F.lit(x)) for x in literals))


def folded(text: Column) -> Column:
    """The text in which literals are looked for: any letters that a pattern takes for one are one."""
    odd = _has(text, tuple(FOLDED))
    return F.lower(F.when(odd, F.translate(text, "".join(FOLDED), "".join(FOLDED.values()))).otherwise(text))


#: Words that turn, and so begin a clause; each pattern puts a line end in place of one character.
TURNS = r"(?:but|however|although|though|yet|whereas|while|instead)[ ,]"
MARKS = ((r"u\.s\.a\.", "usa   "), (r"u\.s\.", "us  "), (r"([.!?;])[ \t\r]", "$1\n"), (f",( {TURNS})", "\n$1"), (f" ({TURNS})", "\n$1"))
#: A clause: up to the end of a sentence, which white space follows, a turn, or the line's end.
CLAUSE = r"[^\n]+"


def marked(low: Column) -> Column:
    """The folded text with line ends where clauses end, of the same length."""
    for pattern, put in MARKS:
        low = F.regexp_replace(low, pattern, put)
    return low


def clauses(low: Column, used: tuple[Rule, ...] = RULES, also: tuple[str, ...] = ()) -> Column:
    """The clauses of a folded text, in order; none if the text has nothing that the rules of clauses need, nor any of ``also``."""
    needs = tuple(dict.fromkeys([*(x for r in used if r.clauses for x in r.needs), *also]))
    if not needs:
        return F.array().cast("array<string>")
    return F.when(_has(low, needs), F.regexp_extract_all(marked(low), F.lit(CLAUSE), 0)).when(low.isNotNull(), F.array().cast("array<string>"))


def in_clause(clause: Column, rule: Rule) -> Column:
    """Whether a rule finds something in a clause."""
    found = _has(clause, rule.needs) & clause.rlike(rule.pattern)
    return found & ~clause.rlike(rule.unless) if rule.unless else found


def matches(text: Column, rule: Rule, low: Column | None = None, parts: Column | None = None) -> Column:
    """Whether a rule finds something; letter case does not count.  Null text gives null.

    ``low`` and ``parts`` are the folded text and its clauses, where columns already hold them.
    """
    low = folded(text) if low is None else low
    if rule.clauses:
        return _has(low, rule.needs) & F.exists(clauses(low, (rule,)) if parts is None else parts, lambda c: in_clause(c, rule))
    found = text.rlike(f"(?iu){rule.pattern}")
    return _has(low, rule.needs) & found if rule.needs else found


def any_of(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether any of the rules finds something."""
    return reduce(lambda a, b: a | b, (matches(text, r) for r in rules), F.when(text.isNotNull(), F.lit(False)))


def let(value: Column, use) -> Column:
    """``use`` of a value that is made once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def evidence(text: Column, low: Column, parts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that find something, each tried once; ``low`` and ``parts`` are best columns of their own."""
    return F.array_compact(F.array(*(F.when(matches(text, r, low, parts), F.lit(r.name)) for r in rules)))


SPAN = T.StructType([T.StructField("rule", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def spans(names: Column, low: Column, parts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Where each rule of clauses among ``names`` finds something first: (rule, start, end) in code points of the text."""
    text = F.concat(F.lit("\n"), marked(low), F.lit("\n"))

    def span(r: Rule) -> Column:
        def place(clause: Column) -> Column:
            core, whole = F.regexp_extract(clause, r.pattern, 1), F.regexp_extract(clause, r.pattern, 0)
            # An equal clause further ahead would have been the first.
            at = F.instr(text, F.concat(F.lit("\n"), clause, F.lit("\n"))) - 1
            begin = at + F.instr(clause, whole) - 1 + F.instr(whole, core) - 1
            return F.struct(F.lit(r.name).alias("rule"), begin.cast("long").alias("start"), (begin + F.length(core)).cast("long").alias("end"))

        return F.when(F.array_contains(names, r.name), let(F.filter(parts, lambda c: in_clause(c, r))[0], place))

    used = [r for r in rules if r.clauses]
    return F.array_compact(F.array(*map(span, used))) if used else F.array().cast(T.ArrayType(SPAN))


def of_kind(names: Column, kind: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether the names that ``evidence`` gave are of a rule of this kind."""
    return F.arrays_overlap(names, F.array(*(F.lit(r.name) for r in rules if r.kind == kind)).cast("array<string>"))


#: Currencies and periods as postings write them.
CURRENCIES = {
    "us$": "USD", "c$": "CAD", "ca$": "CAD", "a$": "AUD", "au$": "AUD", "$": "USD", "usd": "USD", "cad": "CAD", "aud": "AUD", "eur": "EUR", "gbp": "GBP", "chf": "CHF", "\u20ac": "EUR", "\u00a3": "GBP",
    "dollars": "USD", "dollar": "USD", "euros": "EUR", "euro": "EUR", "pounds": "GBP", "pound": "GBP",
}
PERIODS = {
    "hour": "hour", "hr": "hour", "h": "hour", "hourly": "hour", "year": "year", "yr": "year", "y": "year", "annum": "year", "annually": "year", "annual": "year", "yearly": "year", "pa": "year", "p.a": "year",
    "month": "month", "mo": "month", "monthly": "month", "week": "week", "wk": "week", "weekly": "week", "day": "day", "d": "day", "daily": "day",
}
_SIGNED = r"(?:us|ca?|au?)?\$|usd|cad|aud|eur|gbp|chf|\x{20ac}|\x{a3}"
_NUMBER = r"([0-9](?:[0-9,.]*[0-9])?)( ?k)?"
_RANGE = rf"(?: ?(?:-|\x{{2013}}|\x{{2014}}|to|and|up to) ?(?:{_SIGNED})? ?{_NUMBER})?"
_PERIOD = r" ?(?:/ ?(hour|hr|h|year|yr|y|annum|month|mo|week|wk|day|d)|(?:per|an?|each|every|the) (hour|hr|year|yr|annum|month|week|day)|,? ?(hourly|annually|annual|yearly|monthly|weekly|daily|pa|p\.a))"
_CUE = r"salary|salaries|pay|pays|paying|paid|compensation|base|wages?|stipend|ote|earn|earning|remuneration|pay range|rate"
#: Groups of both: currency, amount, thousands, upper amount, its thousands, currency behind; then a period of one of three forms.
PAY = rf"(?:^|[^0-9a-z$.,])({_SIGNED})? ?{_NUMBER}{_RANGE} ?({_SIGNED}|dollars?|euros?|pounds?)?{_PERIOD}(?:$|[^0-9a-z])"
#: The same without a period, where a word beside it speaks of pay.
PAY_CUED = rf"(?:(?:^|[^a-z])(?:{_CUE})(?:[^0-9a-z$]+[a-z]+){{0,4}}?[^0-9a-z$]+({_SIGNED}) ?{_NUMBER}{_RANGE} ?()()()()[.,]?(?:$|[^0-9a-z.,]))"
PAY_BASED = rf"(?:^|[^0-9a-z$.,])({_SIGNED}) ?{_NUMBER}{_RANGE} ?()()()()(?:base|salary|ote|starting|total compensation)(?:$|[^0-9a-z])"
#: A currency beside a digit, without which there is no pay.
MONEY_FIRST = rf"(?:{_SIGNED}) ?[0-9]|[0-9]k? ?(?:{_SIGNED}|dollar|euro|pound)"
#: What a clause speaks of if its money is not the reader's, unless a word of pay stands in it too.
NOT_PAY = word(r"saves?|saving|revenue|raised|funding|fees?|costs?|prices?|priced|budgets?|sales|customers?|discounts?|donat(?:e|es|ed|ions?)|valued|invest(?:ed|ments?)?|rent|subscriptions?|tuition|spend|spends|profit|turnover|fined?|billing|worth|clients?|reimburs(?:e|ed|ement)")
OF_PAY = word(r"salary|salaries|pay|pays|paying|paid|compensation|wages?|stipend|earn|earns|earning|remuneration|ote|you will receive")
MONEY = T.DecimalType(12, 2)
PAY_TYPE = T.StructType([T.StructField("min", MONEY), T.StructField("max", MONEY), T.StructField("currency", T.StringType()), T.StructField("period", T.StringType())])
#: From this amount on, pay without a period is for a year.
YEARLY = 10_000


def _named(value: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.element_at(F.create_map(*pairs), value)


def amount(digits: Column, thousands: Column) -> Column:
    """A number as written: commas part thousands, and so do points where three digits follow each."""
    plain = F.when(digits.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3})+$"), F.replace(digits, F.lit("."), F.lit(""))).otherwise(F.replace(digits, F.lit(","), F.lit("")))
    value = plain.try_cast(MONEY)
    return F.when(F.trim(thousands) != "", value * 1000).otherwise(value).try_cast(MONEY)


def _pay_of(g: Column) -> Column:
    """The pay that the groups of a pattern say, or null."""
    low = amount(g[1], g[2])
    # "$80-90k" states thousands once for both.
    low = F.when((F.trim(g[2]) == "") & (F.trim(g[4]) != ""), (low * 1000).try_cast(MONEY)).otherwise(low)
    ends = F.struct(low.alias("low"), amount(g[3], g[4]).alias("high"), _named(F.coalesce(F.nullif(g[0], F.lit("")), g[5]), CURRENCIES).alias("currency"), _named(F.concat(g[6], g[7], g[8]), PERIODS).alias("period"))

    def made(e: Column) -> Column:
        high = F.coalesce(e["high"], e["low"])
        period = F.coalesce(e["period"], F.when(high >= YEARLY, "year"))
        found = F.struct(F.least(e["low"], high).alias("min"), F.greatest(e["low"], high).alias("max"), e["currency"].alias("currency"), period.alias("period"))
        return F.when(e["low"].isNotNull() & e["currency"].isNotNull(), found)

    return let(ends, made)


def stated(clause: Column) -> Column:
    """The first pay that a clause states, a struct of PAY_TYPE, or null."""

    def read(pattern: str) -> Column:
        # What was found is short; its parts are taken from it.
        parts = lambda whole: F.array(*(F.regexp_extract(whole, pattern, g) for g in range(1, 10)))
        return let(F.regexp_extract(clause, pattern, 0), lambda whole: F.when(whole != "", let(parts(whole), _pay_of)))

    ours = clause.rlike(MONEY_FIRST) & (~clause.rlike(NOT_PAY) | clause.rlike(OF_PAY))
    return F.when(ours, F.coalesce(read(PAY), read(PAY_CUED), read(PAY_BASED)).cast(PAY_TYPE))


#: One of these is in every text with a currency.
MONEY_NEEDS = ("$", "usd", "cad", "aud", "eur", "gbp", "chf", "\u20ac", "\u00a3", "dollar", "pound")


def pay(low: Column, parts: Column | None = None) -> Column:
    """The first pay that the folded text states, a struct of PAY_TYPE, or null.

    ``parts`` are the text's clauses, where a column already holds them.  Only those with a currency are read.
    """
    parts = clauses(low, (), MONEY_NEEDS) if parts is None else parts
    parts = F.when(_has(low, MONEY_NEEDS), F.filter(parts, lambda c: _has(c, MONEY_NEEDS)))
    return F.try_element_at(F.filter(F.transform(parts, stated), lambda p: p.isNotNull()), F.lit(1))
