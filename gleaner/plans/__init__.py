"""gleaner.plans"""
