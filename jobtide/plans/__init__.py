"""jobtide.plans"""
