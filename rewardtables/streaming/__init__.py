"""Evaluation over arriving rollouts."""
