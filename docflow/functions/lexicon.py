"""Default word lists. Fixed values; every operator takes its own list instead."""

from __future__ import annotations

LABELS = ["report", "presentation", "memo", "proposal", "technical", "financial", "marketing", "legal", "other"]

LABEL_TERMS = {
    "report": ["report", "quarterly", "annual", "findings", "results", "summary"],
    "presentation": ["slide", "slides", "presentation", "agenda", "deck"],
    "memo": ["memo", "memorandum", "subject", "cc", "regards"],
    "proposal": ["proposal", "propose", "proposed", "bid", "scope", "deliverables"],
    "technical": ["architecture", "system", "software", "api", "server", "database", "algorithm"],
    "financial": ["revenue", "expenses", "income", "margin", "profit", "budget", "invoice"],
    "marketing": ["campaign", "brand", "customer", "audience", "market", "launch"],
    "legal": ["agreement", "contract", "clause", "party", "liability", "license", "hereby"],
}

POSITIVE = ["good", "great", "excellent", "positive", "improve", "improved", "success", "growth", "happy", "best"]
NEGATIVE = ["bad", "poor", "negative", "loss", "fail", "failed", "risk", "problem", "unhappy", "worst"]

STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]
