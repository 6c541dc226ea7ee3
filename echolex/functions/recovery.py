"""Rules on error events: strategy, fallback and alert text."""

from pyspark.sql import functions as F

from echolex.functions.lexicons import ALERT_FORMAT, DEFAULT_STRATEGY, RECOVERY_STRATEGIES


def recovery_strategy(error_type):
    """Strategy for an error type. The table is small and fixed, so it is a
    literal in the expression and needs no join."""
    chain = F
    for strategy in sorted(set(RECOVERY_STRATEGIES.values()) - {DEFAULT_STRATEGY}):
        kinds = [k for k, v in RECOVERY_STRATEGIES.items() if v == strategy]
        chain = chain.when(error_type.isin(*kinds), strategy)
    return chain.otherwise(DEFAULT_STRATEGY)


# Word in the component name, and the fallback it has.
FALLBACKS = {
    "sentiment": "keyword_scoring",
    "api": "local_processing",
    "database": "cached_data",
}


def fallback_rule(component):
    """Fallback of a component by its name; null when it has none."""
    lowered = F.lower(component)
    chain = F
    for word, fallback in FALLBACKS.items():
        chain = chain.when(lowered.contains(word), fallback)
    return chain


def alert_text(severity, component):
    return F.format_string(ALERT_FORMAT, severity, component)
