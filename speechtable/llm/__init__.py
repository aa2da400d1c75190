"""Operators of a training-data pipeline over documents, vectors and conversations.

Nothing outside this folder (but the driver contract) imports it; it builds on the general helpers of the package.
"""
