"""Lexicon scores from token counts, within a row."""

from pyspark.sql import functions as F

from commwatch.functions.binding import text_list

UNKNOWN_CLASS = -1


def known_tokens(counts, lexicons):
    """The token counts, in the column named ``counts``, whose token is in any of the lexicons.

    Catalyst turns the literal list into a hash set, so a token costs one look-up however many
    lexicons there are.
    """
    every = sorted({w for x in lexicons for c in x.class_ids for w in x.words[c]})
    return F.expr(f"filter({counts}, c -> c.token IN ({text_list(every)}))" if every else counts)


def class_hits(counts, lexicon):
    """Hits per class, in ascending class id order, from the token-count column named ``counts``.

    Each class tries every token, so pass the few that ``known_tokens`` leaves.
    """
    sums = []
    for class_id in lexicon.class_ids:
        words = lexicon.words[class_id]
        if words:
            sums.append(
                f"aggregate({counts}, 0L, (s, h) -> s + IF(h.token IN ({text_list(words)}), h.n, 0L))"
            )
        else:
            sums.append("0L")
    return F.expr(f"array({', '.join(sums)})")


def first_best_class(hits, class_ids):
    """Class with the most hits; ties and no hits at all go to the lowest id."""
    ids = F.array(*[F.lit(c) for c in class_ids])
    return F.get(ids, F.array_position(hits, F.array_max(hits)).cast("int") - 1)


def class_of(total, hits, class_ids):
    """As ``first_best_class``, and -1 for a text without tokens."""
    return F.when(total == 0, F.lit(UNKNOWN_CLASS)).otherwise(first_best_class(hits, class_ids))


def share(hits, total):
    """Hits over all tokens, 0.0 for a text without tokens."""
    return F.when(total == 0, F.lit(0.0)).otherwise(
        hits.cast("double") / F.nullif(total, F.lit(0)).cast("double")
    )


def class_label(class_id, lexicon):
    """Label of a class, null where there is none."""
    pairs = [F.lit(x) for item in sorted(lexicon.labels.items()) for x in item]
    return F.element_at(F.create_map(*pairs), class_id)
