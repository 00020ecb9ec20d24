"""Row-level access: a caller sees their own customer row and no other."""

from __future__ import annotations

from pyspark.sql import DataFrame

from usagemart.functions.text import first_given

ALLOWED, DENIED_OTHER, NO_PROFILE, INVALID = "allowed", "denied_other", "no_profile", "invalid"

_CALLER = first_given("email", "preferred_username")


def caller_info(claims: DataFrame) -> DataFrame:
    """Who calls and what their claims hold. Callers without any name are turned away."""
    return claims.selectExpr(
        f"{_CALLER} AS user_email",
        "email IS NOT NULL AS has_email",
        "preferred_username IS NOT NULL AS has_username",
        "aud AS audience", "iat AS issued_at", "exp AS expires_at",
    ).where("user_email IS NOT NULL")


def access_decisions(claims: DataFrame, mart: DataFrame) -> DataFrame:
    """One decision per request.

    The caller is named by email, else by username. The mart's email is unique (the load refuses
    to publish duplicates), so this is a plain join, and AQE can split a caller with very many
    requests. Requests without any name would all be one NULL key, so they bypass the join.
    """
    requests = claims.selectExpr(
        f"{_CALLER} AS email",
        "requested_customer_id",
        "email IS NOT NULL AS has_email",
        "preferred_username IS NOT NULL AS has_username",
    )
    profiles = mart.where("email IS NOT NULL").select("email", "customer_id")
    known = requests.where("email IS NOT NULL").join(profiles, "email", "left").selectExpr(
        "email", "requested_customer_id", "customer_id",
        f"""CASE WHEN customer_id IS NULL THEN '{NO_PROFILE}'
                 WHEN requested_customer_id <> customer_id THEN '{DENIED_OTHER}'
                 ELSE '{ALLOWED}' END AS decision""",
        "has_email", "has_username")
    nameless = requests.where("email IS NULL").selectExpr(
        "email", "requested_customer_id", "CAST(NULL AS bigint)", f"'{INVALID}'",
        "has_email", "has_username")
    return known.unionAll(nameless)


def allowed_customers(decisions: DataFrame) -> DataFrame:
    """Each customer somebody may see, once however often they asked.

    By customer alone: the requests were joined by email, so this shuffles anyway, and AQE stays
    free to split the join partition of a caller with very many requests.
    """
    return decisions.where(f"decision = '{ALLOWED}'").select("customer_id").distinct()


def restrict(mart: DataFrame, decisions: DataFrame) -> DataFrame:
    """Only the rows that some request may see."""
    return mart.join(allowed_customers(decisions), "customer_id", "left_semi")
