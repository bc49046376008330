"""skygrid.plans"""
