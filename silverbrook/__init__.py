"""Event-to-mart analytics as plain Spark jobs.

Every module holds functions from DataFrame to DataFrame (or to a streaming
query); none of them starts a session.
"""
