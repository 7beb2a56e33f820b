"""Operators put together: stages from messages to messages, and reports."""
