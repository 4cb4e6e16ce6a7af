"""Rhetorical roles of paragraphs: stateless cues as JVM predicates, then a fold over each opinion for the cues that lean
on the paragraph before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from .sequences import near_end

#: Phrases of judgments, by what they show.
SUBMIT = (
    r"(?:submit(?:s|ted)?|contend(?:s|ed)?|argu(?:es|ed)|urg(?:es|ed)|canvass(?:es|ed)|point(?:s|ed) out|rel(?:ies|ied)|plead(?:s|ed)"
    r"|assail(?:s|ed)|defend(?:s|ed)|request(?:s|ed)|took us through)"
)
COUNSEL = r"(?:learned )?(?:senior )?(?:counsel|advocate|amicus(?: curiae)?)"
OFFICER = (
    r"learned (?:additional )?(?:solicitor|advocate|attorney) general|learned (?:additional |special )?public prosecutor"
    r"|learned (?:a\.?s\.?g\.?|a\.?a\.?g\.?|a\.?g\.?)\b"
)
NAMED = r"(?i)(?:Shri|Sri|Mr\.?|Ms\.?|Mrs\.?|Dr\.?|Smt\.?)\s+[A-Z][\w.' ]{2,40},?\s+learned (?:senior )?(?:counsel|advocate|amicus)"
VERB = rf"(?i)\b{SUBMIT}\b|\bsubmissions?\b|\bcontentions?\b|\bvehemently\b"
BOTH = r"(?i)\b(?:we|i) have heard\b|\bheard (?:the )?learned counsel\b"
CONTRA = r"(?i)^\W*[\d.]*\W*(?:per contra|on the other hand|in reply|in response|in rebuttal)\b"
GOES_ON = (
    rf"(?i)^\W*[\d.]*\W*(?:it (?:was|is|has been) (?:further |also |next |lastly |then |finally )?{SUBMIT}"
    rf"|(?:he|she|they|learned (?:senior )?counsel) (?:has |have )?(?:further |also |next |lastly |then |finally )?{SUBMIT}"
    r"|according to (?:him|her|them|learned counsel)|(?:his|her|their) (?:next|further|last) (?:submission|contention))"
)
ISSUE = (
    r"(?i)(?:questions?|issues?|points?) (?:that |which )?(?:arises?|falls?|fall) for (?:our )?(?:consideration|determination|decision)"
    r"|(?:questions?|issues?|points?) for (?:our )?(?:consideration|determination|decision)"
    r"|the (?:short|only|sole|core|principal|moot|substantial) (?:question|issue|point)"
    r"|following (?:questions?|issues?|points?) (?:arise|arises|were framed|was framed|were referred|was referred)"
)
RULING = (
    r"(?i)(?:appeals?|petitions?|writ petitions?|review petitions?|applications?|references?|suit) (?:is|are|stands?|shall stand) "
    r"(?:accordingly |hereby |therefore |thus )?(?:partly )?(?:allowed|dismissed|disposed of|answered|decreed|rejected)"
    r"|\b(?:we|i) (?:accordingly |therefore |hereby |thus )?(?:allow|dismiss) (?:the |this |these |both )?(?:appeals?|petitions?|applications?|writ|review|suit|revision)"
    r"|\b(?:we|i) (?:accordingly |therefore |hereby |thus )?(?:set aside|quash|dispose of|remand|remit|direct that|answer the reference|hold and declare|declare that)"
    r"|(?:judgment|order|conviction|sentence|proceedings?|f\.?i\.?r\.?)[^.]{0,80}?(?:is|are|stands?) (?:hereby |accordingly )?(?:set aside|quashed|affirmed|upheld|confirmed|restored)"
    r"|(?:is|are|stands?) (?:hereby )?(?:struck down|declared (?:to be )?unconstitutional|overruled)"
    r"|the reference is answered|no order as to costs|ordered accordingly|pending applications?"
)
BELOW = (
    r"(?i)the (?:learned )?(?:trial court|trial judge|sessions (?:judge|court)|high court|single judge|division bench|tribunal|magistrate"
    r"|first appellate court|appellate (?:court|authority)|commission|court below|courts below)[^.]{0,140}?(?:held|convicted|acquitted"
    r"|dismissed|allowed|decreed|rejected|found|observed|quashed|sentenced|took the view|declined|refused|upheld|affirmed|confirmed"
    r"|concluded|opined|granted)"
)
QUOTES_LAW = (
    r"(?i)(?:reads?|provides?|runs?|stipulates?|lays? down) (?:as (?:under|follows)|thus)"
    r"|(?:is|are) (?:extracted|reproduced|quoted|set out) (?:below|hereunder|herein ?below|as under)"
)
PRECEDENT = (
    r"(?i)this court (?:in|has held|had held|held|observed|laid down|ruled)|it was (?:held|observed|laid down)"
    r"|(?:constitution|larger|three-judge|two-judge|coordinate|full|nine-judge|seven-judge|five-judge) bench"
    r"|(?:was|were) (?:followed|approved|affirmed|overruled|distinguished)|\(supra\)"
)
FACTS = (
    r"(?i)the (?:brief |relevant |essential |material |undisputed )?facts|facts (?:of the case|in brief|leading to)"
    r"|the prosecution (?:case|story|version)|factual (?:matrix|background|backdrop)|briefly stated"
    r"|f\.?i\.?r\.? (?:was|came to be) (?:registered|lodged)|first information report (?:was|with) "
    r"|charge-?sheet (?:was|came to be) filed|(?:was|were) (?:charged|arrested|tried|convicted) "
)
ANALYSIS = (
    r"(?i)\b(?:we|i) (?:are|am) of the (?:considered |firm |clear )?(?:view|opinion)"
    r"|\b(?:we|i) (?:find|hold|think|see no|do not (?:find|agree|think)|have (?:considered|given|carefully)|are unable|am unable|agree|note|conclude)\b"
    r"|in (?:our|my) (?:view|opinion|considered|judgment)|having (?:heard|considered|regard)"
    r"|it is (?:well |now |trite |no longer )?(?:settled|res integra)|the law is (?:well )?settled|we now (?:turn|proceed)"
)
OPENING = 420
PARTY_ROLES = ("argument_petitioner", "argument_respondent", "argument")


def side(party: str) -> str:
    """Pattern of a party's counsel or submission."""
    return (
        rf"(?i){COUNSEL}[^.]{{0,90}}?(?:for|on behalf of|representing) (?:the )?{party}|(?:on behalf of|for) (?:the )?{party}[^.]{{0,160}}?{SUBMIT}"
        rf"|\bthe {party} (?:{SUBMIT}|would (?:submit|contend|argue)|ha(?:s|ve) (?:{SUBMIT}))"
    )


def _place(text: Column, pattern: str) -> Column:
    """Where a pattern first matches; null if nowhere."""
    return F.when(text.rlike(pattern), F.length(F.split(text, pattern, 2)[0]))


def label(df: DataFrame, has_statute: Column, has_case: Column) -> DataFrame:
    """df(case_id, segment, para_seq, text, heading, case_name) with role.

    has_statute and has_case tell whether a paragraph cites a provision or a case. Null texts count as empty and null
    segments as one. The role before is forgotten where an opinion begins.
    """
    text = F.coalesce("text", F.lit(""))
    own = F.regexp_replace(text, tx.OPEN_QUOTES, " ")
    opening = F.substring(own, 1, OPENING)
    state = tx.state_side(F.col("case_name"))
    named = tx.heading_role(F.col("heading"), state)
    party = lambda c: c.isin(*PARTY_ROLES)
    speakers = [
        (side(tx.PETITIONER.removeprefix("(?i)")), F.lit("argument_petitioner")),
        (side(tx.RESPONDENT.removeprefix("(?i)")), F.lit("argument_respondent")),
        (side(tx.STATE) + "|" + OFFICER, F.coalesce(F.concat(F.lit("argument_"), state), F.lit("argument"))),
        (NAMED, F.lit("argument")),
    ]
    found = F.array_sort(F.array_compact(F.array(*[F.when(opening.rlike(p), F.struct((r == "argument").cast("int").alias("vague"), _place(opening, p).alias("at"), r.alias("role"))) for p, r in speakers])))
    sides = F.size(F.array_distinct(F.transform(F.filter(found, lambda s: s["vague"] == 0), lambda s: s["role"])))
    speaks = (F.size(found) > 0) & opening.rlike(VERB) & ~(opening.rlike(BOTH) & (sides > 1))
    quoted = tx.quoted_share(text)
    later = (
        F.when(party(named), named)
        .when(own.rlike(ISSUE), "issue")
        .when(F.col("near_end") & own.rlike(RULING), "ruling")
        .when(opening.rlike(BELOW), "lower_court")
        .when(named.isNotNull(), named)
        .when(own.rlike(QUOTES_LAW) & has_statute & (quoted >= 0.3), "statute")
        .when(own.rlike(ANALYSIS), "analysis")
        .when(has_case & ((quoted >= 0.4) | own.rlike(PRECEDENT)), "precedent")
        .when(own.rlike(FACTS), "facts")
        .otherwise("unlabelled")
    )
    df = near_end(df.withColumn("segment", F.coalesce("segment", F.lit(0))), ["case_id", "segment"], ["para_seq"])
    cues = df.select(
        "case_id", "segment", "para_seq",
        F.when(speaks, "said").when(own.rlike(CONTRA), "contra").when(own.rlike(GOES_ON), "goes_on").otherwise("other").alias("cue"),
        F.when(speaks, F.try_element_at(found, F.lit(1))["role"]).otherwise(later).alias("role"),
        F.when(party(named), named).otherwise("argument").alias("fallback"),
    )
    # A paragraph whose role doesn't lean on the one before is an anchor. Behind it the first paragraph that does settles a party,
    # and each later change of sides turns it; so running counts tell every role, and no opinion is gathered.
    anchor = F.col("cue").isin("said", "other")
    line = Window.partitionBy("case_id", "segment").orderBy("para_seq")
    run = Window.partitionBy("case_id", "segment", "run").orderBy("para_seq").rowsBetween(Window.unboundedPreceding, 0)
    turned = lambda r: F.when(r == "argument_petitioner", "argument_respondent").when(r == "argument_respondent", "argument_petitioner").otherwise("argument")
    cues = cues.withColumn("run", F.sum(anchor.cast("int")).over(line))
    cues = cues.withColumn("before", F.first(F.when(anchor, F.col("role")), True).over(run)).withColumn("nth", F.sum((~anchor).cast("int")).over(run))
    settled = F.when(F.col("cue") == "contra", turned(F.col("before"))).otherwise(F.when(party(F.col("before")), F.col("before")).otherwise(F.col("fallback")))
    cues = cues.withColumn("settled", F.first(F.when(F.col("nth") == 1, settled), True).over(run)).withColumn("turns", F.sum(((F.col("cue") == "contra") & (F.col("nth") > 1)).cast("int")).over(run))
    role = F.when(anchor, F.col("role")).when(F.col("turns") % 2 == 0, F.col("settled")).otherwise(turned(F.col("settled")))
    flat = cues.select("case_id", "segment", "para_seq", role.alias("role"))
    return df.join(flat, ["case_id", "segment", "para_seq"])
