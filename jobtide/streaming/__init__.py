"""jobtide.streaming"""
