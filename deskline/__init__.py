"""Cleaning of customer-interaction texts and preparation of labelled intent tables
on Spark: every operator takes a DataFrame and returns one."""

from deskline.operators.channels import clean_interactions
from deskline.operators.chat import clean_chats
from deskline.operators.email import EmailConfig, clean_emails
from deskline.operators.transcript import clean_transcripts

__all__ = ["EmailConfig", "clean_chats", "clean_emails", "clean_interactions", "clean_transcripts"]
