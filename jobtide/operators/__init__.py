"""jobtide.operators"""
