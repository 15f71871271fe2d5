"""gleaner.operators"""
