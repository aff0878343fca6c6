"""Challenge-page detection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.text import fill


def title_reason(title: Column) -> Column:
    """``title:<keyword>`` for the first listed keyword in the title, else null."""
    return let(
        F.lower(title),
        lambda low: F.coalesce(*[F.when(low.contains(k), F.lit("title:" + k)) for k in K.ANTI_BOT_TITLE]),
    )


def body_reason(body: Column) -> Column:
    """``body:<phrase start>`` for the first listed phrase in the body text, else null."""
    return let(
        F.lower(body),
        lambda low: F.coalesce(*[F.when(low.contains(k), F.lit("body:" + k[:40])) for k in K.ANTI_BOT_BODY]),
    )


def anti_bot_error(title: Column, body: Column) -> Column:
    """Error text of a challenge page; a title hit wins over a body hit; null when clean."""
    return fill(K.ERR_ANTI_BOT, F.coalesce(title_reason(title), body_reason(body)))


def may_hold_phrase(tokens: Column) -> Column:
    """False only when no body phrase can occur: its last word is nowhere in the joined text tokens."""
    endings = sorted({phrase.split()[-1] for phrase in K.ANTI_BOT_BODY})
    shown = F.regexp_replace(F.array_join(tokens, ""), f"{K.T_HIDE}[^{K.T_SHOW}]*{K.T_SHOW}", "")

    def any_ending(low):
        rule = F.lit(False)
        for word in endings:
            rule = rule | low.contains(word)
        return rule

    return let(F.lower(shown), any_ending)
