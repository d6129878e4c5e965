"""A lemma dictionary derived from the corpus itself.

Suffix rules propose base forms for every distinct token and a proposal is accepted
when it occurs as a token of the corpus (the detachment rules and lexicon test of
WordNet's morphological processor). Irregular forms come from a short list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# English suffix rules (suffix, replacement), best first.
SUFFIX_RULES = [
    ("sses", "ss"), ("ches", "ch"), ("shes", "sh"), ("xes", "x"), ("zes", "z"),
    ("ies", "y"), ("ves", "f"), ("men", "man"), ("s", ""), ("es", ""),
    ("ied", "y"), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
]
IRREGULAR = {
    "am": "be", "are": "be", "is": "be", "was": "be", "were": "be", "been": "be",
    "being": "be", "has": "have", "had": "have", "having": "have", "does": "do",
    "did": "do", "done": "do", "doing": "do", "went": "go", "gone": "go", "goes": "go",
    "said": "say", "made": "make", "took": "take", "taken": "take", "came": "come",
    "saw": "see", "seen": "see", "knew": "know", "known": "know", "got": "get",
    "gave": "give", "given": "give", "found": "find", "thought": "think",
    "told": "tell", "became": "become", "left": "leave", "felt": "feel",
    "brought": "bring", "began": "begin", "begun": "begin", "kept": "keep",
    "held": "hold", "wrote": "write", "written": "write", "stood": "stand",
    "heard": "hear", "meant": "mean", "met": "meet", "ran": "run", "paid": "pay",
    "led": "lead", "grew": "grow", "grown": "grow", "lost": "lose", "fell": "fall",
    "fallen": "fall", "sent": "send", "built": "build", "spoke": "speak",
    "spoken": "speak", "chose": "choose", "chosen": "choose", "won": "win",
    "children": "child", "feet": "foot", "teeth": "tooth", "mice": "mouse",
    "geese": "goose", "people": "person", "better": "good", "best": "good",
    "worse": "bad", "worst": "bad",
}
MIN_STEM = 3


def distinct_tokens(docs: DataFrame) -> DataFrame:
    """Distinct ``token`` values of a ``tokens`` list column."""
    return docs.select(F.explode(F.array_distinct("tokens")).alias("token")).distinct()


def derive_lemmas(tokens: DataFrame) -> DataFrame:
    """(token, lemma) for the tokens whose lemma differs from themselves."""
    token = F.col("token")
    proposals = F.filter(
        F.array(
            *[
                F.when(
                    token.endswith(suffix) & (F.length(token) >= len(suffix) + MIN_STEM),
                    F.struct(
                        F.lit(order).alias("rule"),
                        F.concat(
                            F.expr(f"left(token, length(token) - {len(suffix)})"),
                            F.lit(replacement),
                        ).alias("lemma"),
                    ),
                )
                for order, (suffix, replacement) in enumerate(SUFFIX_RULES)
            ]
        ),
        lambda p: p.isNotNull(),
    )
    listed = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    irregular = tokens.withColumn("lemma", listed[token]).filter(F.col("lemma").isNotNull())
    proposed = (
        tokens.filter(~token.isin(list(IRREGULAR)))
        .select("token", F.explode(proposals).alias("p"))
        .select("token", "p.rule", "p.lemma")
    )
    regular = (
        proposed.join(tokens.withColumnRenamed("token", "lemma"), "lemma", "left_semi")
        .groupBy("token")
        .agg(F.min_by("lemma", "rule").alias("lemma"))
    )
    return regular.unionByName(irregular.select("token", "lemma"))
