"""Streaming: intentionally empty.

The reference is a one-shot batch build (files -> register -> exports); it
has no watermark, window, state, trigger, queue or change feed (SURVEY §2.14).
No streaming operator is built; the batch jobs in ``addrlink.plans`` are the
whole surface.
"""
