"""Errors of model calls, classified by name and message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of messages that tell the kind of an error, and names of errors.
CONTEXT_LENGTH = (
    "context length", "maximum context length", "maximum context", "token limit", "too long", "context window",
    "context_window_exceeded", "maximum tokens", "input too long", "length limit", "context_length_exceeded",
)
OUTPUT_LENGTH = ("lengthfinishreasonerror", "finish_reason", "length limit was reached", "response was truncated")
SAFETY = ("invalid_prompt", "safety reasons", "limited access to this content", "content_policy_violation", "content policy")
TRANSIENT = ("timed out", "timeout", "rate limit", "temporarily unavailable", "connection reset", "503", "504", "502")
TRANSIENT_NAMES = ("RateLimitError", "APIConnectionError", "APITimeoutError", "InternalServerError")
# What one provider adds to those lists; it has no kinds of its own but transient and critical ones.
OVERLOADED_PROVIDER, OVERLOADED, OVERLOADED_NAME = "anthropic", "overloaded", "OverloadedError"
# Names of critical errors and what they mean.
CRITICAL = {
    "BadRequestError": "invalid_request",
    "AuthenticationError": "authentication_error",
    "PermissionDeniedError": "permission_denied",
    "NotFoundError": "not_found",
    "UnprocessableEntityError": "unprocessable_request",
}


def has_any(message: Column, parts: tuple[str, ...]) -> Column:
    return F.lower(message).rlike("|".join(p.replace(".", r"\.") for p in parts))


def transient(name: Column, message: Column, provider: Column) -> Column:
    """Whether a failed call may be tried again, by the lists of its provider."""
    extra = (provider == OVERLOADED_PROVIDER) & ((name == OVERLOADED_NAME) | F.lower(message).contains(OVERLOADED))
    return name.isin(*TRANSIENT_NAMES) | has_any(message, TRANSIENT) | extra


def reason(name: Column, message: Column, provider: Column | None = None) -> Column:
    """The first kind that fits, in the order context, output, safety, transient, by name; for
    the provider that has an overloaded error only the last two."""
    provider = F.lit("openai") if provider is None else provider
    own = provider != OVERLOADED_PROVIDER
    out = (
        F.when(own & has_any(message, CONTEXT_LENGTH), "context_length")
        .when(own & has_any(message, OUTPUT_LENGTH), "output_length_limit")
        .when(own & has_any(message, SAFETY), "safety_block")
        .when(transient(name, message, provider), "transient_api_error")
    )
    for k, v in CRITICAL.items():
        out = out.when(name == k, v)
    return out.otherwise("unexpected_error")


def severity(why: Column) -> Column:
    return F.when(why.isin("context_length", "output_length_limit", "safety_block", "transient_api_error"), "recoverable").otherwise("critical")


# How messages of context errors state numbers of tokens.
TOKEN_PHRASES = {
    "max_context": r"maximum context length is\s*([0-9,]+)\s*tokens",
    "requested": r"(?:resulted in|you requested)\s*([0-9,]+)\s*tokens",
    "prompt": r"([0-9,]+)\s*in your prompt",
    "completion": r"([0-9,]+)\s*for completion",
}


def token_details(message: Column) -> Column:
    """struct(max_context, requested, prompt, completion): tokens that a context error states;
    null where it states none."""
    number = lambda phrase: F.replace(F.nullif(F.regexp_extract(message, "(?i)" + phrase, 1), F.lit("")), F.lit(","), F.lit("")).try_cast("bigint")
    return F.struct(*[number(phrase).alias(name) for name, phrase in TOKEN_PHRASES.items()])


def requested_tokens(message: Column) -> Column:
    """Tokens that a context error says were asked for; null where it says none."""
    return token_details(message)["requested"]
