"""Distribution arithmetic on array columns.

One row holds one position's logits. Maxima and log-sums are bound once per
row with ``bind``: a lambda that names an outer expression would evaluate it
again for every element, and the optimizer may inline a helper column there.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    """Sum of an array of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(values: Column) -> Column:
    return values.cast("array<double>")


def log_softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Log-softmax of ``logits / temperature``, shifted by the maximum."""
    scaled = F.transform(as_doubles(logits), lambda x: x / F.lit(float(temperature)))

    def shifted(xs):
        return bind(
            F.array_max(xs),
            lambda top: bind(
                F.log(F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))) + top,
                lambda norm: F.transform(xs, lambda x: x - norm),
            ),
        )

    return bind(scaled, shifted)


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    return F.transform(log_softmax(logits, temperature), lambda x: F.exp(x))


def kl_divergence(log_p: Column, log_q: Column) -> Column:
    """Sum of p (ln p - ln q); terms with p = 0 count as 0."""
    return total(
        F.zip_with(
            log_p,
            log_q,
            lambda p, q: F.when(F.exp(p) > 0, F.exp(p) * (p - q)).otherwise(F.lit(0.0)),
        )
    )


def jensen_shannon(log_t: Column, log_s: Column, beta: float) -> Column:
    """Generalised divergence: beta 0 forward KL, 1 reverse KL, else a mix."""
    if beta == 0:
        return kl_divergence(log_t, log_s)
    if beta == 1:
        return kl_divergence(log_s, log_t)
    mix = F.zip_with(
        log_t,
        log_s,
        lambda t, s: F.log(F.exp(t) * F.lit(beta) + F.exp(s) * F.lit(1.0 - beta) + F.lit(TINY)),
    )
    return bind(
        mix,
        lambda m: kl_divergence(log_t, m) * F.lit(beta)
        + kl_divergence(log_s, m) * F.lit(1.0 - beta),
    )


def top_entries(log_probs: Column, k: int) -> Column:
    """``k`` largest (token_id, logprob), ties to the lower id."""
    ranked = F.sort_array(
        F.transform(log_probs, lambda x, i: F.struct(x.alias("logprob"), (-i).alias("rank_id"))),
        asc=False,
    )
    return F.transform(
        F.slice(ranked, 1, k),
        lambda e: F.struct((-e["rank_id"]).alias("token_id"), e["logprob"].alias("logprob")),
    )
